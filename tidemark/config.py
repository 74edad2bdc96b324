"""Table specs and fixed values of the CDC lakehouse.

Every silver table is described by one ``TableSpec``; the generic silver job
(``tidemark.plans.silver``) reads nothing but the spec, so adding a feed means
adding a spec, not a job.
"""

from __future__ import annotations

from dataclasses import dataclass

# --- fixed values (must stay equal to the modelled pipeline) -----------------
# Zone / domain literals written into every silver row.
ZONE_AREA = "silver"
BUSINESS_AREA = "commercial"
SOURCE_SYSTEM = "erp"
# Change operations in the landed feed: insert, update, delete.
OP_INSERT, OP_UPDATE, OP_DELETE = "I", "U", "D"
UPSERT_OPS = ("I", "U")
ALL_OPS = ("I", "U", "D")
# Landing partitions and stored silver timestamps use a fixed UTC-3 offset.
LOCAL_OFFSET_HOURS = 3
# Landed change timestamp text format (microseconds, fixed width; built by
# functions.time.format_extract_at without the session time zone).
EXTRACT_AT_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
# Parse pattern: accepts 0, 3 or 6 fraction digits.
EXTRACT_AT_PARSE = "yyyy-MM-dd HH:mm:ss[.SSSSSS]"
# Sale-size buckets on the line amount: <= SMALL is Small, <= MEDIUM is Medium.
BUCKET_SMALL_MAX = 50000
BUCKET_MEDIUM_MAX = 75000
# Fixed partition for full-load files dropped at a table root.
BACKFILL_PARTITION = ("2026", "01", "01", "00")
# Landing partition columns (UTC-3 wall clock of the change).
PARTITION_COLS = ("year_stream", "month_stream", "day_stream", "hour_stream")
LINEAGE_COLS = ("zone_area", "business_area", "source_system", "dataset")
# Tie order of change operations with equal timestamps: D beats U beats I.
OP_RANK = {"I": 0, "U": 1, "D": 2}


@dataclass(frozen=True)
class TableSpec:
    """How one bronze change feed becomes one silver table.

    keys        business key used both to dedupe and to merge
    ops         change operations admitted (``UPSERT_OPS`` or ``ALL_OPS``)
    columns     silver payload columns in output order, as
                (name, spark SQL expression over the bronze row)
    tiebreak    payload columns ordering rows with equal change timestamps
                (default: all non-key payload columns)
    shift_ts    store ``extract_at`` shifted to UTC-3 (True) or as landed
    replay      hours re-read below the high watermark on incremental runs
    dedupe      keep the latest image per key (False only for parity runs)
    partition   (column, source timestamp): partition value of the stored table,
                the source's hour (``yyyyMMddHH``) by default, day or month
                by deployment choice (None: unpartitioned, rewritten whole)
    """

    name: str
    keys: tuple[str, ...]
    ops: tuple[str, ...]
    columns: tuple[tuple[str, str], ...]
    tiebreak_cols: tuple[str, ...] | None = None
    shift_ts: bool = True
    replay_hours: int = LOCAL_OFFSET_HOURS
    dedupe: bool = True
    partition: tuple[str, str] | None = None  # (column, source timestamp column)

    @property
    def column_names(self) -> list[str]:
        return [c for c, _ in self.columns]

    @property
    def tiebreak(self) -> list[str]:
        """Columns ordering rows with equal change time and operation.

        Defaults to every non-key payload column, so the latest image is a
        function of the data alone (same result on every run and engine).
        """
        if self.tiebreak_cols is not None:
            return list(self.tiebreak_cols)
        return [c for c in self.column_names if c not in self.keys]

    @property
    def output_columns(self) -> list[str]:
        return self.column_names + list(LINEAGE_COLS) + ["extract_at"]


def _same(*names: str) -> tuple[tuple[str, str], ...]:
    return tuple((n, n) for n in names)


CUSTOMERS = TableSpec(
    name="customers",
    keys=("customernumber",),
    ops=UPSERT_OPS,
    columns=_same(
        "customernumber", "customername", "contactlastname", "contactfirstname",
        "phone", "addressline1", "addressline2", "city", "state", "postalcode",
        "country",
    )
    + (
        ("salesrepemployeenumber", "coalesce(salesrepemployeenumber, 0L)"),
        ("creditlimit", "cast(creditlimit as double)"),
    ),
)

EMPLOYEES = TableSpec(
    name="employees",
    keys=("employeenumber",),
    ops=UPSERT_OPS,
    columns=_same("employeenumber", "lastname", "firstname", "extension", "email")
    + (
        ("officecode", "cast(officecode as bigint)"),
        ("reportsto", "coalesce(reportsto, 0L)"),
        ("jobtitle", "jobtitle"),
    ),
)

OFFICES = TableSpec(
    name="offices",
    keys=("officecode",),
    ops=UPSERT_OPS,
    columns=(("officecode", "cast(officecode as bigint)"),)
    + _same("city", "phone", "addressline1", "addressline2", "state", "country",
            "postalcode", "territory"),
)

ORDERS = TableSpec(
    name="orders",
    keys=("ordernumber",),
    ops=ALL_OPS,
    columns=(
        ("ordernumber", "cast(ordernumber as bigint)"),
        ("orderdate", "orderdate - INTERVAL 3 HOURS"),
        ("orderyearmonth",
         "cast(year(orderdate - INTERVAL 3 HOURS) * 100 + month(orderdate - INTERVAL 3 HOURS) as bigint)"),
        ("customernumber", "customernumber"),
    ),
    partition=("orderdate_hour", "orderdate"),
)

PRODUCTS = TableSpec(
    name="products",
    keys=("productcode",),
    ops=UPSERT_OPS,
    columns=_same(
        "productcode", "productname", "productline", "productfamily", "productscale",
        "productvendor", "productdescription", "quantityinstock",
    )
    + (
        ("buyprice", "cast(buyprice as double)"),
        ("msrp", "cast(msrp as double)"),
    ),
)

# Order lines: deduped on three columns, stored with the unshifted change time
# and no replay window (a line arriving with an older timestamp is not re-read).
ORDERDETAILS = TableSpec(
    name="orderdetails",
    keys=("ordernumber", "productcode", "orderlinenumber"),
    ops=UPSERT_OPS,
    columns=(
        ("ordernumber", "ordernumber"),
        ("orderdate", "orderdate"),
        ("productcode", "productcode"),
        ("quantityordered", "quantityordered"),
        ("priceeach", "cast(priceeach as double)"),
        ("orderlinenumber", "orderlinenumber"),
        ("amount", "cast(quantityordered * priceeach as double)"),
    ),
    tiebreak_cols=("quantityordered", "priceeach"),
    shift_ts=False,
    replay_hours=0,
    partition=("orderdate_hour", "orderdate"),
)

SPECS = {s.name: s for s in (CUSTOMERS, EMPLOYEES, OFFICES, ORDERS, PRODUCTS, ORDERDETAILS)}

GOLD_KEYS = ("locality_officecode", "interval_portsales", "calendar_sales_date")
GOLD_COLUMNS = (
    "locality_officecode", "locality_city", "locality_state", "locality_country",
    "locality_territory", "interval_portsales", "calendar_sales_date",
    "calendar_month_number", "calendar_monthname_full", "calendar_monthname_short",
    "calendar_quarter", "calendar_year", "sales_quantityordered", "sales_amount",
)
