"""Near-duplicate documents by circulant MinHash, with exact verification.

Signatures. A document's set holds its distinct 5-word shingles as 64-bit hashes.
The first permutation sends a shingle to a place on a circle of ``CIRCLE`` places;
the second, a fixed random permutation of the circle, is shifted by one place for
each next coordinate, so two permutations give all coordinates. ``BANDS`` bands of
``ROWS`` coordinates are hashed; equal bands put sets in one bucket.

Verification. Equal sets are one node from the start. In each bucket the member
that meets the most others is the centre, and every member is compared with it on
full sets. What this leaves in another component than its centre (a member not
linked with the centre) is compared with the other components around it by their
*differences* from the centre: D(x) holds the shingles of x outside the centre and
those of the centre that x lacks. D(x) and D(y) differ in as many shingles as x and
y do, so linked sets, which differ in at most k = (1 - s) / (1 + s) of |x| + |y|,
share at least t = (|D(x)| + |D(y)| - k (|x| + |y|)) / 2 differences. x is not linked
with the centre, that is |D(x)| > k (|x| + |centre|), so t is positive whatever y is
(``kept_differences`` has the bounds), and the two share a difference among the first
|D| - t + 1 of both, in an order that begins with the differences that fewest sets
around the centre have, with t - 1 more after it. Copies of one text share its shingles
but hardly their edits, so where a group of n copies falls apart, about n differences
are compared, not n * n pairs.

Where many members share a difference, as families of copies around one centre do, they
are first compared with one of them for each difference, in at most ``ROUNDS`` rounds
while these find links; then the components that are left are compared with each other.
No link between components is lost. Pairs that share rare differences enough for a link
and still have none are decided one by one.

At the threshold of 0.85 a pair meets in some band with probability 1 - 3e-6
(``(1 - .85 ** ROWS) ** BANDS`` is the miss); every link is then decided exactly.

Defined results: a text that is null or without words has the empty set and is
linked with nothing; fewer words than five are one shingle; very long texts count
whole (a task holds one set of 8 bytes a word); a null doc_id keeps a
null component and stays (``kept``); rows that repeat a doc_id are judged by their
own texts, and of rows with the smallest doc_id all stay; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import batches, materialize, rows_of, text_or_empty
from tidemark.llm.components import connected_components

WORDS = 5
BANDS, ROWS = 26, 5
CIRCLE = 1 << 20
SEED = 20240229
CROWD, ROUNDS = 16, 3
CACHED_WORDS = 150_000
#: multipliers of the shingle hash, one per word, and of the band hash, one per coordinate
WORD_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], dtype=np.uint64)

SIGNATURES = "doc_id long, row_key long, n_shingles long, node binary, bands array<long>"
#: the order in which rows stand for their component: smallest doc_id, rows without one last
FIRST = "struct(doc_id is null as nameless, doc_id, row_key)"
SETS = "id long, n long, shingles binary"
STAR = "id long, centre long, n long, d long, linked boolean, m long, differences array<long>"

_tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}


class WordHashes(dict):
    """word -> 64-bit hash, bounded."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


_hashes = WordHashes()


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingles(text: bytes) -> np.ndarray:
    """Sorted distinct hashes of a UTF-8 text's shingles; bytes.lower() and
    bytes.split() lower-case A-Z and split at 0x09-0x0D and 0x20 alone."""
    words = text.lower().split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    lookup = _hashes
    h = np.array([lookup[w] for w in words], dtype=np.uint64)
    n = min(len(h), WORDS)
    rows = len(h) - n + 1
    total = np.full(rows, n, dtype=np.uint64)
    for j in range(n):
        total += mix(h[j : j + rows] + np.uint64(j)) * WORD_FACTORS[j]
    return np.unique(mix(total))


def circle() -> tuple[np.ndarray, np.ndarray]:
    """Every run of ``BANDS * ROWS`` places of the second permutation, as a view,
    and the factors of the band hash."""
    if not _tables:
        rng = np.random.default_rng(SEED)
        order = rng.permutation(CIRCLE).astype(np.uint32)
        runs = np.lib.stride_tricks.sliding_window_view(np.concatenate([order, order[: BANDS * ROWS]]), BANDS * ROWS)
        _tables[0] = runs, rng.integers(1, 2**63, size=ROWS, dtype=np.uint64) | np.uint64(1)
    return _tables[0]


def signature(hashes: np.ndarray) -> np.ndarray:
    """All coordinates: coordinate k is the least value at place(shingle) + k."""
    runs, _ = circle()
    place = (hashes >> np.uint64(44)).astype(np.int64)
    return np.minimum.reduce([runs[place[i : i + 4096]].min(axis=0) for i in range(0, len(place), 4096)])


def bands(hashes: np.ndarray) -> np.ndarray:
    coordinates = signature(hashes).reshape(BANDS, ROWS).astype(np.uint64)
    h = (coordinates * circle()[1]).sum(axis=1, dtype=np.uint64)
    return mix(h + np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)


def row_key() -> Column:
    """A hash of the text: what tells rows of one doc_id, or of none, apart."""
    return F.xxhash64(F.col("text").cast("string"))


def keyed_texts(docs: DataFrame) -> DataFrame:
    """doc_id, row_key, place (where a text is found: its doc_id, or its hash), text."""
    doc_id = F.col("doc_id").cast("long")
    return docs.select(doc_id.alias("doc_id"), row_key().alias("row_key"), F.coalesce(doc_id, row_key()).alias("place"), text_or_empty().cast("binary").alias("text"))


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, row_key, n_shingles, node (128-bit hash of the set, null if empty), bands."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("doc_id", pa.int64()), ("row_key", pa.int64()), ("n_shingles", pa.int64()), ("node", pa.binary()), ("bands", pa.list_(pa.int64()))])

        def rows() -> Iterator[tuple]:
            for batch in parts:
                for doc_id, key, text in rows_of(batch):
                    s = shingles(text)
                    yield (doc_id, key, len(s), xxhash.xxh3_128_digest(s.tobytes()), bands(s)) if len(s) else (doc_id, key, 0, None, None)

        yield from batches(rows(), schema, 2048)

    return keyed_texts(docs).select("doc_id", "row_key", "text").mapInArrow(run, SIGNATURES)


def sets_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The full sets of ``wanted`` (id, node, place), from the texts."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            last = None
            for batch in parts:
                for id_, node, text in rows_of(batch):
                    s = shingles(text)
                    if id_ != last and xxhash.xxh3_128_digest(s.tobytes()) == node:  # a repeated place may have another text
                        last = id_
                        yield id_, len(s), s.tobytes()

        yield from batches(rows(), pa.schema([("id", pa.int64()), ("n", pa.int64()), ("shingles", pa.binary())]), 256)

    # The same plan at every size: the candidates grow with the documents.
    texts = keyed_texts(docs).select("place", "text")
    return texts.join(wanted.hint("merge"), "place").select("id", "node", "text").mapInArrow(run, SETS)


def similar(x: np.ndarray, y: np.ndarray, percent: int) -> tuple[bool, np.ndarray]:
    """Whether two sets are at least ``percent`` similar; which of x are in y."""
    at = np.searchsorted(y, x)
    at[at == len(y)] = 0
    common = y[at] == x
    both = int(common.sum())
    return 100 * both >= percent * (len(x) + len(y) - both), common


def with_sets(pairs: DataFrame, sets: DataFrame, a: str, b: str) -> DataFrame:
    left = sets.select(F.col("id").alias(a), F.col("shingles").alias("x"))
    right = sets.select(F.col("id").alias(b), F.col("shingles").alias("y"))
    return pairs.join(left, a).join(right, b).select(a, b, "x", "y")


def kept_differences(n: int, m: int, d: int, linked: bool, least_d: int, most_n: int, percent: int) -> tuple[int, int]:
    """How many of a set's ``d`` differences from its centre (of size ``m``) are to be
    looked at: for partners of any kind, and for partners that are not linked with the
    centre. Those have at least ``least_d`` differences; no set around has more than
    ``most_n`` shingles.

    With k = (100 - percent) / (100 + percent), a partner y and t as above:
    * a set linked with the centre meets only sets that are not: t > (1 - k) d / 2;
    * any other shares at most all |D(y)|, and |y| <= m + |D(y)|, so
      t >= (d - k (n + m)) / (1 + k);
    * if y is not linked with the centre, t > (d - k (n - m)) / 2, and
      t >= (d + least_d - k (n + most_n)) / 2.
    """
    up, down = 100 + percent, 100 - percent
    near = -(-(up * (d + least_d) - down * (n + min(most_n, 100 * n // percent))) // (2 * up))
    if linked:
        least = max(1, -(-percent * d // up), near)
        return max(0, d - least + 1), 0
    least = max(1, -(-(up * d - down * (n + m)) // 200))
    strict = max(least, -(-(up * d - down * (n - m)) // (2 * up)), near)
    return max(0, d - least + 1), max(0, d - strict + 1)


def compared_with_centres(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """For pairs (id, centre): the sizes n and m, whether they are linked, and the
    differences, of which there are d."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("id", pa.int64()), ("centre", pa.int64()), ("n", pa.int64()), ("d", pa.int64()), ("linked", pa.bool_()), ("m", pa.int64()), ("differences", pa.list_(pa.int64()))])

        def rows() -> Iterator[tuple]:
            for batch in parts:
                for id_, centre, x, y in rows_of(batch):
                    x, y = np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64)
                    linked, common = similar(x, y, percent)
                    differences = np.concatenate([x[~common], np.setdiff1d(y, x, assume_unique=True)])
                    yield id_, centre, len(x), len(differences), linked, len(y), differences.view(np.int64)

        yield from batches(rows(), schema, 256)

    return with_sets(pairs, sets, "id", "centre").mapInArrow(run, STAR)


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are at least ``percent`` similar."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in parts:
                for a, b, x, y in rows_of(batch):
                    if similar(np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64), percent)[0]:
                        yield a, b

        yield from batches(rows(), pa.schema([("a", pa.int64()), ("b", pa.int64())]))

    return with_sets(pairs, sets, "a", "b").mapInArrow(run, "a long, b long")


def links(docs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """(node, component), by id, of the distinct sets that are linked with another."""
    members = nodes.select("id", F.explode("bands").alias("band"))
    shared = materialize(members.groupBy("band").agg(F.count("*").alias("size")).where("size > 1"), "dup-buckets")
    met = materialize(members.join(shared, "band"), "dup-met")
    each = materialize(met.groupBy("id").agg(F.sum("size").alias("meets")), "dup-meets")
    wanted = materialize(each.join(nodes.select("id", "node", "place"), "id").select("id", "node", "place"), "dup-wanted")
    sets = materialize(sets_of(docs, wanted), "dup-sets")

    centres = met.join(each, "id").groupBy("band").agg(F.max_by("id", F.struct("meets", "id")).alias("centre"))
    around = met.join(materialize(centres, "dup-centres"), "band").select("id", "centre").distinct()
    star = materialize(compared_with_centres(materialize(around, "dup-around"), sets, percent), "dup-star")
    edges = star.where("linked and id <> centre").select(F.col("id").alias("a"), F.col("centre").alias("b"))
    first = connected_components(edges)

    # Centres that members of other components stand around.
    own = materialize(labelled(star, first), "dup-own")
    main = own.where("id = centre").select("centre", F.col("component").alias("main")).distinct()
    mixed = materialize(own.join(main, "centre").where("component <> main").select("centre").distinct(), "dup-mixed")
    around = own.join(mixed, "centre").select("centre", "id", "n", "d", "linked", "m", F.explode("differences").alias("shingle"), "component")
    placed = materialize(in_order(materialize(around, "dup-differences"), percent), "dup-placed")
    shared_ = materialize(shared_differences(placed), "dup-shared")
    for _ in range(ROUNDS):
        if not crowded(shared_):
            break
        more = materialize(verified(materialize(one_for_each(shared_, percent), "dup-round"), sets, percent), "dup-round-links")
        if more.isEmpty():
            break
        edges = edges.union(more)
        first = connected_components(edges)
        shared_ = materialize(shared_differences(labelled(shared_.drop("component"), first)), "dup-shared")
    pairs = materialize(across(shared_, percent), "dup-rest")
    more = materialize(verified(pairs, sets, percent), "dup-rest-links")
    return first if more.isEmpty() else connected_components(edges.union(more))


def labelled(rows: DataFrame, component: DataFrame) -> DataFrame:
    """Rows with the component of ``id``; sets without a link are their own."""
    return rows.join(component.withColumnRenamed("node", "id"), "id", "left").withColumn("component", F.coalesce("component", "id"))


def in_order(around: DataFrame, percent: int) -> DataFrame:
    """The differences that more than one component around a centre holds, each with its
    place ``at`` among its set's, rarest first, as far as they are to be looked at:
    ``strict`` of them for partners that are not linked with the centre."""
    held = around.groupBy("centre", "shingle").agg(F.count("*").alias("holders"), F.min("component").alias("low"), F.max("component").alias("high"))
    shared = around.join(held.where("low < high").select("centre", "shingle", "holders"), ["centre", "shingle"])
    own = Window.partitionBy("centre", "id")  # the differences of one set
    at = F.col("d") - F.count("*").over(own) + F.row_number().over(own.orderBy("holders", "shingle")) - 1
    sizes = around.groupBy("centre").agg(F.min(F.expr("if(linked, null, d)")).alias("least_d"), F.max("n").alias("most_n"))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            bounds = [kept_differences(*row, percent) for row in zip(*(batch.column(c).to_pylist() for c in ("n", "m", "d", "linked", "least_d", "most_n")), strict=True)]
            first, strict = (pa.array([b[i] for b in bounds], pa.int64()) for i in (0, 1))
            out = batch.select(PLACED[:-1]).append_column("strict", strict)
            yield out.filter(pc.less(batch.column("at"), first))

    placed = shared.withColumn("at", at.cast("long")).join(sizes, "centre")
    return placed.mapInArrow(run, "centre long, shingle long, id long, n long, d long, linked boolean, component long, at long, strict long")


PLACED = ["centre", "shingle", "id", "n", "d", "linked", "component", "at", "strict"]


def shared_differences(placed: DataFrame) -> DataFrame:
    """The rows whose difference more than one component around the centre holds."""
    held = placed.groupBy("centre", "shingle").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    return placed.join(held.where("low < high").select("centre", "shingle"), ["centre", "shingle"])


def crowded(shared: DataFrame) -> bool:
    """Whether pairs of rows with one difference are many times as many as the rows."""
    groups = shared.groupBy("centre", "shingle").count()
    total = groups.agg(F.sum("count").alias("rows"), F.sum(F.expr("double(count) * (count - 1) / 2")).alias("pairs")).first()
    return (total.pairs or 0) > CROWD * (total.rows or 0)


def may_link(percent: int) -> str:
    """Sizes fit, and from the shared difference on both hold as many as a link needs."""
    up, down = 100 + percent, 100 - percent
    return (
        f"100 * least(n, o_n) >= {percent} * greatest(n, o_n)"
        f" and {2 * up} * least(d - at, o_d - o_at) >= {up} * (d + o_d) - {down} * (n + o_n)"
    )


SIDE = ("id", "n", "d", "at", "component")


def pairs_of(met: DataFrame, percent: int) -> DataFrame:
    met = met.where("component <> o_component").where(may_link(percent))
    return met.select(F.least("id", "o_id").alias("a"), F.greatest("id", "o_id").alias("b")).distinct()


def one_for_each(shared: DataFrame, percent: int) -> DataFrame:
    """Pairs of each set and one holder of each of its differences: the holder that
    shares the most differences. At most one pair for a row."""
    weight = shared.groupBy("centre", "id").agg(F.count("*").alias("weight"))
    weighted = shared.join(weight, ["centre", "id"])
    chosen = weighted.groupBy("centre", "shingle").agg(F.max_by(F.struct(*SIDE), F.struct("weight", "id")).alias("o"))
    chosen = chosen.select("centre", "shingle", *(F.col(f"o.{c}").alias(f"o_{c}") for c in SIDE))
    return pairs_of(shared.join(chosen, ["centre", "shingle"]), percent)


def across(shared: DataFrame, percent: int) -> DataFrame:
    """Pairs of different components that may be linked. One side is not linked with the
    centre; partners that are not either meet on their ``strict`` differences alone."""
    free = shared.where("not linked")
    strict = free.where("at < strict")
    others = lambda rows: rows.select("centre", "shingle", *(F.col(c).alias(f"o_{c}") for c in SIDE))
    both = strict.join(others(strict), ["centre", "shingle"]).where("component < o_component")
    one = free.join(others(shared.where("linked")), ["centre", "shingle"])
    return pairs_of(both, percent).union(pairs_of(one, percent)).distinct()


def judged(docs: DataFrame, percent: int, nameless: bool = False) -> DataFrame:
    """Every row's doc_id, row_key and n_shingles, and ``best``: doc_id and row_key of the
    row that stands for its component (``FIRST``), null for empty sets and, unless
    ``nameless`` rows take part, for rows without a doc_id."""
    rows = materialize(signatures(docs), "dup-signatures")
    judged_ = rows.where("node is not null") if nameless else rows.where("doc_id is not null and node is not null")
    of_set = judged_.groupBy("node").agg(F.min(F.expr(FIRST)).alias("best"), F.first("n_shingles").alias("n_shingles"), F.first("bands").alias("bands"))
    of_set = of_set.withColumn("place", F.coalesce("best.doc_id", "best.row_key")).withColumn("id", F.monotonically_increasing_id())
    nodes = materialize(of_set, "dup-nodes")
    component = links(docs, nodes, percent)
    of_node = nodes.select("id", "node", "best").join(component.withColumnRenamed("node", "id"), "id", "left")
    of_node = materialize(of_node.select("node", "best", F.coalesce("component", "id").alias("component")), "dup-components")
    smallest = materialize(of_node.groupBy("component").agg(F.min("best").alias("best")), "dup-smallest")
    final = materialize(of_node.select("node", "component").join(smallest, "component").select("node", "best"), "dup-final")
    # An empty set has a key of its own, which matches nothing.
    out = rows.select("doc_id", "row_key", "n_shingles", "node").withColumn("node", F.coalesce("node", F.unhex(F.hex(F.xxhash64("doc_id", "row_key")))))
    out = out.join(final, "node", "left").drop("node")
    return out if nameless else out.withColumn("best", F.when(F.col("doc_id").isNotNull(), F.col("best")))


def near_duplicates(docs: DataFrame, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs`` (doc_id, text)."""
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("best.doc_id", "doc_id"))
    out = judged(docs, percent).select("doc_id", "n_shingles", own.alias("component_id"))
    return out.withColumn("kept", F.col("component_id").eqNullSafe(F.col("doc_id")))


def op2_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP2_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
  FROM documents
), grams AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) < 5 THEN array_to_string(w, ' ') ELSE array_to_string(w[i : i + 4], ' ') END AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM words WHERE len(w) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id
), pairs AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared FROM grams x JOIN grams y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM pairs JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE 100 * shared >= 85 * (p.n + q.n - shared)
), reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM words UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other
), component AS (
  SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM component LEFT JOIN sizes USING (doc_id)
"""
