"""Near-duplicate documents by DartMinHash signatures and banded joining.

A document is the multiset of its shingles of five words; weights are how often each occurs.
Every shingle owns a region of the plane, as wide as its weight; hashed darts fall into the
plane at rate one per unit area, the same for all documents, and each coordinate of a signature
keeps the dart of its own with the lowest rank. Two documents agree in a coordinate with
probability sum(min) / sum(max) of their weights. Work per document is one cell per shingle
plus about k ln k darts, not shingles times coordinates.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from matchlake.llm.graph import components
from matchlake.llm.shared import Scratch, two_hashes

SHINGLE_WORDS = 5
THRESHOLD = 0.8
#: One minus similarity is a metric: a text less similar than this to another text is similar to
#: none that is similar to that one.
OUTER = 2 * THRESHOLD - 1
#: Slack of bounds on similarities, well above their rounding.
SLACK = 1e-9
BANDS, BAND_ROWS = 24, 5
#: A pair at the threshold shares no band with probability (1 - 0.8 ** 5) ** 24 < 1e-4.
COORDINATES = BANDS * BAND_ROWS
#: Rounds of leaders go on while they link this share of what is left.
FAIR_SHARE = 0.05
#: Documents of a chunk, and columns of a matrix, when chunks are compared.
CHUNK = 128
COLUMNS = 1 << 14
#: Cells thrown at a time, which bounds the memory of a task whatever the texts.
CELLS = 1 << 18
REMEMBERED_WORDS = 200_000
REMEMBERED_BAGS = 64

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_GOLD = np.uint64(0x9E3779B97F4A7C15)
#: Probability that a unit cell holds at most 0, 1, ... darts.
_POISSON = np.cumsum([math.exp(-1) / math.factorial(i) for i in range(20)])


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    with np.errstate(over="ignore"):
        x = x + _GOLD
        x = (x ^ (x >> np.uint64(30))) * _M1
        x = (x ^ (x >> np.uint64(27))) * _M2
        return x ^ (x >> np.uint64(31))


def _unit(x: np.ndarray) -> np.ndarray:
    return (x >> np.uint64(11)).astype(np.float64) * 2.0**-53


class WordHashes(dict):
    """Hash of a word, remembered for a bounded number of words."""

    def __missing__(self, word: str) -> int:
        if len(self) >= REMEMBERED_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word.encode("utf-8", "replace"))
        return value


def shingles(text: str, known: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of a whole text, ascending, and how often each occurs.

    Words are runs between white space, lower-cased. A text of one to four words is one shingle
    of all of them; a text without words is one shingle that all such texts share.
    """
    words = text.lower().split()
    size = min(SHINGLE_WORDS, len(words))
    if not size:
        return np.array([1], np.uint64), np.array([1], np.int64)
    codes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    last = len(words) - size + 1
    value = np.full(last, size, np.uint64)
    for i in range(size):
        value = mixed(value ^ codes[i : i + last])
    return np.unique(value, return_counts=True)


def _throw(
    element: np.ndarray, weight: np.ndarray, doc: np.ndarray, reach: np.ndarray
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Darts (document and coordinate, rank, dart) of rank below ``reach`` of a document.

    The weight axis is cut at 0, 1, 2, 4, 8, ...; a stretch of width w is cut along the rank
    axis every 1 / w, so that all cells have area one. A cell's hash gives its number of darts
    (Poisson) and each dart's place; darts above the weight or the reach are not its document's.
    """
    stretch = np.maximum(1, np.ceil(np.log2(np.maximum(weight, 1))).astype(np.int64) + 1)
    owner = np.repeat(np.arange(len(element)), stretch)
    level = np.arange(len(owner)) - np.repeat(np.cumsum(stretch) - stretch, stretch)
    width = np.where(level == 0, 1.0, 2.0 ** (level - 1))
    low = np.where(level == 0, 0.0, width)
    cells = np.ceil(reach[doc[owner]] * width).astype(np.int64)
    ends = np.cumsum(cells)
    total = int(ends[-1]) if len(ends) else 0
    for begin in range(0, total, CELLS):
        index = np.arange(begin, min(begin + CELLS, total))
        region = np.searchsorted(ends, index, "right")
        row = index - (ends[region] - cells[region])
        with np.errstate(over="ignore"):
            place = level[region].astype(np.uint64) << np.uint64(48) | row.astype(np.uint64)
            cell = mixed(element[owner[region]] ^ mixed(place))
            darts = np.searchsorted(_POISSON, _unit(cell), "right")
            many = np.repeat(np.arange(len(cell)), darts)
            nth = np.arange(len(many)) - np.repeat(np.cumsum(darts) - darts, darts)
            dart = mixed(cell[many] + _GOLD * (nth + 1).astype(np.uint64))
        region = region[many]
        across = low[region] + width[region] * _unit(mixed(dart ^ _M1))
        rank = (row[many] + _unit(mixed(dart ^ _M2))) / width[region]
        owned = owner[region]
        inside = (across < weight[owned]) & (rank < reach[doc[owned]])
        dart, rank, owned = dart[inside], rank[inside], owned[inside]
        coordinate = (mixed(dart ^ _GOLD) % np.uint64(COORDINATES)).astype(np.int64)
        yield doc[owned] * COORDINATES + coordinate, rank, dart


def signatures(bags: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """One row of ``COORDINATES`` darts per bag of (element hashes, weights), none of them empty.

    About k ln k + 2 k darts fill all coordinates of most bags. Where one stays empty, the bag
    is thrown again up to twice the rank; lower darts stay the same, so nothing changes but that.
    """
    darts = np.zeros(len(bags) * COORDINATES, np.uint64)
    ranks = np.full(len(bags) * COORDINATES, np.inf)
    expected = COORDINATES * (math.log(COORDINATES) + 2)
    todo = np.arange(len(bags))
    while len(todo):
        chosen = [bags[i] for i in todo]
        element = np.concatenate([b[0] for b in chosen])
        weight = np.concatenate([b[1] for b in chosen]).astype(np.float64)
        doc = np.repeat(np.arange(len(chosen)), [len(b[0]) for b in chosen])
        reach = expected / np.bincount(doc, weight, len(chosen))
        for slot, rank, dart in _throw(element, weight, doc, reach):
            slot = todo[slot // COORDINATES] * COORDINATES + slot % COORDINATES
            order = np.lexsort((rank, slot))
            slot, rank, dart = slot[order], rank[order], dart[order]
            first = np.concatenate(([True], slot[1:] != slot[:-1])) if len(slot) else slot
            slot, rank, dart = slot[first], rank[first], dart[first]
            better = rank < ranks[slot]
            ranks[slot[better]], darts[slot[better]] = rank[better], dart[better]
        empty = np.isinf(ranks.reshape(len(bags), COORDINATES)).any(axis=1)
        todo, expected = np.flatnonzero(empty), expected * 2
    return darts.reshape(len(bags), COORDINATES)


def band_keys(signature: np.ndarray) -> np.ndarray:
    """One key per band: equal where two signatures agree in all coordinates of the band."""
    parts = signature.reshape(len(signature), BANDS, BAND_ROWS)
    key = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), parts.shape[:2])
    for i in range(BAND_ROWS):
        key = mixed(key ^ parts[:, :, i])
    return key.view(np.int64)


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known = WordHashes()
    for batch in batches:
        texts = batch.column("text")
        done = 0
        while done < len(texts):
            bags, cells = [], 0
            while done + len(bags) < len(texts) and cells < CELLS and len(bags) < 512:
                bags.append(shingles(texts[done + len(bags)].as_py(), known))
                cells += max(len(bags[-1][0]), COORDINATES * 7)
            keys = band_keys(signatures(bags))
            rows = batch.slice(done, len(bags)).select(["id", "c1", "c2"])
            weight = [int(b[1].sum()) for b in bags]
            done += len(bags)
            yield pa.RecordBatch.from_arrays(
                [
                    *rows.columns,
                    pa.array(weight, pa.int64()),
                    pa.array(keys.tolist(), pa.list_(pa.int64())),
                ],
                names=["id", "c1", "c2", "weight", "bands"],
            )


def similarity(
    a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]
) -> float:
    """Weighted Jaccard similarity of two bags: sum of lesser over sum of greater weights."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    shared = int(np.minimum(a[1][i], b[1][j]).sum())
    return shared / (int(a[1].sum()) + int(b[1].sum()) - shared)


def _similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known, bags = WordHashes(), {}

    def bag(doc: int, text: pa.Scalar) -> tuple[np.ndarray, np.ndarray]:
        """Shingles of a document; leaders come again and again, so a few are remembered."""
        if doc not in bags:
            if len(bags) >= REMEMBERED_BAGS:
                bags.pop(next(iter(bags)))
            bags[doc] = shingles(text.as_py(), known)
        return bags[doc]

    for batch in batches:
        scores = []
        left, right = batch.column("text_a"), batch.column("text_b")
        ends = zip(batch.column("a").to_pylist(), batch.column("b").to_pylist())
        for i, (a, b) in enumerate(ends):
            scores.append(similarity(bag(a, left[i]), bag(b, right[i])))
        scored = batch.select(["a", "b"]).append_column("s", pa.array(scores, pa.float64()))
        yield scored.filter(pa.array([x >= OUTER - SLACK for x in scores], pa.bool_()))


def _exact(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Similarity of the whole texts of the pairs (a, b), where it is ``OUTER`` or more."""
    left = texts.select(F.col("id").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("id").alias("b"), F.col("text").alias("text_b"))
    both = pairs.join(right, "b").join(left, "a").select("a", "b", "text_a", "text_b")
    return both.mapInArrow(_similar, "a long, b long, s double")


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known = WordHashes()
    for batch in batches:
        made = [shingles(x.as_py(), known) for x in batch.column("text")]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("id"),
                pa.array([b[0].view(np.int64) for b in made], pa.list_(pa.int64())),
                pa.array([b[1] for b in made], pa.list_(pa.int64())),
            ],
            names=["id", "codes", "counts"],
        )


def overlaps(left: list[tuple], right: list[tuple]) -> np.ndarray:
    """Sum of the lesser weights of every bag of ``left`` with every bag of ``right``.

    The lesser of two weights is the sum over levels of whether both reach it, so each distinct
    level is one matrix product, over columns taken ``COLUMNS`` at a time.
    """
    total = np.zeros((len(left), len(right)))
    sides = []
    for side in (left, right):
        rows = np.repeat(np.arange(len(side)), [len(b[0]) for b in side])
        sides.append((rows, np.concatenate([b[0] for b in side]), np.concatenate([b[1] for b in side])))
    common = np.intersect1d(sides[0][1], sides[1][1])
    for start in range(0, len(common), COLUMNS):
        part = common[start : start + COLUMNS]
        grids = []
        for (rows, codes, counts), side in zip(sides, (left, right)):
            at = np.searchsorted(part, codes)
            hit = (at < len(part)) & (part[np.minimum(at, len(part) - 1)] == codes)
            grid = np.zeros((len(side), len(part)), np.float32)
            grid[rows[hit], at[hit]] = counts[hit]
            grids.append(grid)
        before = 0.0
        for level in np.unique(np.concatenate([np.unique(g[g > 0]) for g in grids])):
            used = (grids[0] >= level).any(axis=0) & (grids[1] >= level).any(axis=0)
            if not used.any():
                break
            a, b = ((g[:, used] >= level).astype(np.float32) for g in grids)
            total += (level - before) * (a @ b.T)
            before = level
    return total


def _compare(left: pa.Table, right: pa.Table) -> pa.Table:
    """Similar pairs (a < b) of two chunks of one bucket."""
    sides = []
    for table, names in ((left, ("id", "codes", "counts")), (right, ("other", "keys", "times"))):
        columns = [table.column(c).to_pylist() for c in names]
        bags = [(np.array(k, np.int64), np.array(n, np.int64)) for k, n in zip(*columns[1:])]
        sides.append((np.array(columns[0], np.int64), bags))
    (a, bags_a), (b, bags_b) = sides
    if not len(a) or not len(b):
        return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
    shared = overlaps(bags_a, bags_b)
    weight_a = np.array([x[1].sum() for x in bags_a])[:, None]
    weight_b = np.array([x[1].sum() for x in bags_b])
    similar = (shared >= THRESHOLD * (weight_a + weight_b - shared)) & (a[:, None] != b)
    i, j = np.nonzero(similar)
    return pa.table({"a": np.minimum(a[i], b[j]), "b": np.maximum(a[i], b[j])})


def _bags_of(ids: DataFrame, texts: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """Bags of the texts of some ids, written once."""
    return scratch.put(
        texts.join(ids.select("id").distinct(), "id", "left_semi").mapInArrow(
            _bags, "id long, codes array<long>, counts array<long>"
        ),
        name,
    )


def _chunked_links(member: DataFrame, texts: DataFrame, scratch: Scratch) -> DataFrame:
    """Every similar pair within the buckets of ``member`` (band, id), chunk against chunk.

    What leaves a task are the similar pairs alone.
    """
    bags = _bags_of(member, texts, scratch, "bags")
    sizes = member.groupBy("band").agg(
        F.ceil(F.count(F.lit(1)) / F.lit(CHUNK)).cast("int").alias("chunks")
    )
    dealt = (
        member.select("band", "id")
        .join(sizes, "band")
        .withColumn("chunk", F.pmod(F.xxhash64("id"), "chunks").cast("int"))
        .join(bags, "id")
    )
    # The two sides come from one table, so each names its columns anew.
    left = dealt.select(
        F.col("band").alias("g"),
        F.col("chunk").alias("i"),
        F.explode(F.expr("sequence(chunk, chunks - 1)")).alias("j"),
        F.col("id").alias("id"),
        F.col("codes").alias("codes"),
        F.col("counts").alias("counts"),
    )
    right = dealt.select(
        F.col("band").alias("h"),
        F.explode(F.expr("sequence(0, chunk)")).alias("i"),
        F.col("chunk").alias("j"),
        F.col("id").alias("other"),
        F.col("codes").alias("keys"),
        F.col("counts").alias("times"),
    )
    return (
        left.groupBy("g", "i", "j")
        .cogroup(right.groupBy("h", "i", "j"))
        .applyInArrow(_compare, "a long, b long")
        .distinct()
    )


def _chained_links(
    met: DataFrame, label: DataFrame, texts: DataFrame, scratch: Scratch
) -> DataFrame | None:
    """Similar pairs of a follower of a leader and a member that the leader did not take.

    ``met`` holds (lead, id, s) of all rounds. By the triangle inequality only members of
    similarity ``OUTER`` or more to the leader can be similar to a follower, and to none that is
    closer to the leader by more than the distance of similar texts. Members that other links
    joined to the leader's class need no further link. The rest are compared chunk against chunk.
    """
    of = label.select(F.col("node").alias("lead"), F.col("component").alias("of"))
    own = label.select(F.col("node").alias("id"), F.col("component").alias("own"))
    outer = scratch.put(
        met.where(F.col("s") < THRESHOLD)
        .join(of, "lead")
        .join(own, "id", "left")
        .where(F.coalesce("own", "id") != F.col("of"))
        .groupBy("lead", "id")
        .agg(F.max("s").alias("s")),
        "outer",
    )
    closest = outer.groupBy("lead").agg(F.max("s").alias("closest"))
    inner = scratch.put(
        met.where(F.col("s") >= THRESHOLD)
        .join(closest, "lead")
        .where(F.col("s") <= F.col("closest") + F.lit(1 - THRESHOLD + SLACK))
        .select("lead", "id")
        .distinct(),
        "inner",
    )
    if inner.isEmpty():
        return None
    bags = _bags_of(inner.select("id").unionByName(outer.select("id")), texts, scratch, "bags-met")

    def sizes(side: DataFrame, name: str) -> DataFrame:
        chunks = F.ceil(F.count(F.lit(1)) / F.lit(CHUNK)).cast("int")
        return side.groupBy("lead").agg(chunks.alias(name))

    grid = scratch.put(sizes(inner, "m").join(sizes(outer, "n"), "lead"), "grid")
    left = (
        inner.join(grid, "lead")
        .join(bags, "id")
        .select(
            F.col("lead").alias("g"),
            F.pmod(F.xxhash64("id"), "m").cast("int").alias("i"),
            F.explode(F.expr("sequence(0, n - 1)")).alias("j"),
            F.col("id").alias("id"),
            F.col("codes").alias("codes"),
            F.col("counts").alias("counts"),
        )
    )
    right = (
        outer.join(grid, "lead")
        .join(bags, "id")
        .select(
            F.col("lead").alias("h"),
            F.explode(F.expr("sequence(0, m - 1)")).alias("i"),
            F.pmod(F.xxhash64("id"), "n").cast("int").alias("j"),
            F.col("id").alias("other"),
            F.col("codes").alias("keys"),
            F.col("counts").alias("times"),
        )
    )
    return scratch.put(
        left.groupBy("g", "i", "j")
        .cogroup(right.groupBy("h", "i", "j"))
        .applyInArrow(_compare, "a long, b long")
        .distinct(),
        "links-chained",
    )


def _banded_classes(reps: DataFrame, docs: DataFrame, scratch: Scratch) -> DataFrame:
    """Classes (node, component) of representatives by verified links where a band key is shared.

    A bucket is the set of documents with one band key. In a round, its most central members
    lead: those that share most keys with others, such as the text that near copies were made
    from. Every other member is compared with each leader; members that are similar to one are
    linked and leave the bucket. A bucket of copies of one text is done in one round, with one
    pair per member. Rounds go on while they link a fair share of what is left; then only texts
    remain that share a key with others without being copies of their centre, and they are
    compared chunk against chunk. At last, followers are compared with the members their leader
    did not take. No bucket is cut short: every pair that shares a key is compared, or both ends
    are in one class already, or their similarities to a leader rule it out.
    """
    near = F.least("weight", "w") >= (OUTER - SLACK) * F.greatest("weight", "w")
    every = reps.select("id", "weight", F.explode("bands").alias("band"))
    shared = scratch.put(
        every.groupBy("band").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "shared"
    )
    every = scratch.put(every.join(shared, "band"), "members")
    central = every.groupBy("id").agg(F.sum("n").alias("central"))
    member = scratch.put(every.drop("n").join(central, "id"), "members-0")
    # The ids grow with the documents, so they are never broadcast, however few they are.
    ids = central.select("id").hint("merge")
    texts = scratch.put(docs.join(ids, "id", "left_semi"), "texts")
    scored, step, left = None, 0, member.count()
    if not left:
        return member.selectExpr("id AS node", "id AS component")
    links = None
    order = Window.partitionBy("band").orderBy(F.desc("central"), "id")
    while left:
        leader = (
            member.withColumn("k", F.row_number().over(order))
            .where("k = 1")
            .select("band", F.col("id").alias("lead"), F.col("weight").alias("w"))
        )
        leader = scratch.put(leader, f"leaders-{step}")
        met = (
            member.join(leader, "band")
            .where((F.col("id") != F.col("lead")) & near)
            .select("band", "id", "lead", F.least("id", "lead").alias("a"), F.greatest("id", "lead").alias("b"))
        )
        pairs = scratch.put(met.select("a", "b").distinct(), f"pairs-{step}")
        exact = scratch.put(_exact(pairs, texts), f"exact-{step}")
        found = exact.where(F.col("s") >= THRESHOLD).select("a", "b")
        links = found if links is None else links.unionByName(found)
        ends = met.select("id", "lead", "a", "b").distinct().join(exact, ["a", "b"])
        now = scratch.put(ends.select("lead", "id", "s"), f"met-{step}")
        scored = now if scored is None else scored.unionByName(now)
        gone = met.join(found, ["a", "b"], "left_semi").select("band", "id")
        gone = gone.unionByName(leader.select("band", F.col("lead").alias("id")))
        rest = scratch.put(
            member.join(gone.distinct(), ["band", "id"], "left_anti"), f"rest-{step}"
        )
        several = rest.groupBy("band").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        linked = left - leader.count() - rest.count()
        member = scratch.put(rest.join(several, "band", "left_semi"), f"members-{step + 1}")
        if linked < FAIR_SHARE * left:
            found = scratch.put(_chunked_links(member, texts, scratch), "links-chunked")
            links = links.unionByName(found)
            break
        step, left = step + 1, member.count()
    label = scratch.put(components(links, scratch), "classes")
    found = _chained_links(scored, label, texts, scratch)
    if found is None or found.isEmpty():
        return label
    joined = label.select(F.col("node").alias("a"), F.col("component").alias("b"))
    return components(joined.unionByName(found), scratch)


def near_duplicates(
    docs: DataFrame, text: str = "text", id_col: str = "doc_id"
) -> DataFrame:
    """Class of every document under weighted Jaccard similarity of at least ``THRESHOLD``.

    Returns one row per input row: (doc_id, component_id, kept), component_id being the lowest
    id of the documents reachable by links and kept whether the row's id is that. Equal texts
    are one document to the search, whatever their number; others are found by bands and proven
    on their whole texts. Texts without words are copies of each other. A null text or a null id
    belongs to no class: its component is its own id and it is kept. Rows that repeat an id are
    one document.
    """
    scratch = Scratch(docs.sparkSession, "near-dedup")
    rows = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text}`").alias("text")
    )
    real = rows.where("id is not null and text is not null")
    c1, c2 = two_hashes(F.col("text"))
    signed = scratch.put(
        real.select("id", c1.alias("c1"), c2.alias("c2"), "text").mapInArrow(
            _sign, "id long, c1 long, c2 long, weight long, bands array<long>"
        ),
        "signed",
    )
    lowest = F.min(F.struct("id", "weight", "bands")).alias("r")
    reps = scratch.put(
        signed.groupBy("c1", "c2").agg(lowest).select("c1", "c2", "r.*"), "representatives"
    )
    label = _banded_classes(reps, real, scratch)
    named = scratch.put(
        reps.select("c1", "c2", "id")
        .join(label, F.col("id") == F.col("node"), "left")
        .select("c1", "c2", F.coalesce("component", "id").alias("component_id")),
        "named",
    )
    classed = signed.select("id", "c1", "c2").join(named, ["c1", "c2"])
    alone = rows.where("id is null or text is null").select("id", F.col("id").alias("component_id"))
    return (
        classed.select("id", "component_id")
        .unionByName(alone)
        .select(
            F.col("id").alias("doc_id"),
            "component_id",
            F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"),
        )
    )


def one_of_each(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """The documents with one of each class: that of the lowest id; rows of one id and text once."""
    lasting = near_duplicates(docs, text, id_col).where("kept and doc_id is not null")
    key = F.col(f"`{id_col}`")
    none = docs.where(key.isNull())
    ids = lasting.select(F.col("doc_id").alias("_kept_id")).distinct().hint("merge")
    kept = docs.join(ids, key.cast("long") == F.col("_kept_id"), "left_semi")
    return kept.dropDuplicates([id_col, text]).unionByName(none)

