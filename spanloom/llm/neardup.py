"""Near-duplicate documents by SetSketch registers, band joins and checks of full sets of words."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanloom.llm import sketch, words
from spanloom.llm.components import connected_components
from spanloom.llm.shared import broadcast_if_small, drop_table, join_hot, without_ids, write_table

REGISTERS, ROWS = 128, 4
#: Buckets of more members are checked by pairs of blocks of about BLOCK members, and of this many set elements.
SMALL_BUCKET, BLOCK, BLOCK_ELEMENTS = 64, 1024, 1 << 20
#: Members of small buckets, and pairs of blocks, of one task (about).
TASK_MEMBERS, TASK_BLOCKS = 4096, 2
#: Ids of documents to check that are broadcast at most (16 MB of longs).
BROADCAST_IDS = 2_000_000


def _rows(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Lower-cased bytes and offsets of a text column, in slices."""
    data, offsets = words.text_bytes(column)
    for i, j in words.slices(offsets):
        yield words.LOWER[data[offsets[i] : offsets[j]]], offsets[i : j + 1] - offsets[i]


def _sketches(shingle: int, m: int):
    seed = sketch.seeds(m)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, digest, regs = [], [], []
            for part, offsets in _rows(batch.column(1)):
                starts, ends, bounds = words.spans(part, offsets, words.SOLID)
                sets = words.shingles(words.fingerprints(part, starts, ends), bounds, shingle)
                for s, text in zip(sets, words.normal(part, offsets, words.SOLID)):
                    n.append(len(s))
                    digest.append(hashlib.blake2b(text, digest_size=16).digest() if len(s) else None)
                    regs.append(sketch.registers(s, seed).tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(digest, pa.binary()), pa.array(regs, pa.binary())], ["id", "n", "digest", "regs"])

    return run


def _normal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in words.parts(batch, 1):
            texts = [t for data, offsets in _rows(part.column(1)) for t in words.normal(data, offsets, words.SOLID)]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.binary())], ["id", "words"])


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(len(column), -1)


def _likely(least: float):
    """Pairs whose likeliest similarity is at least `least`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                a, b, n_a, n_b, u, v = batch.columns
                found = sketch.similarity(_matrix(u), _matrix(v), n_a.to_numpy().astype(float), n_b.to_numpy().astype(float))
                yield pa.RecordBatch.from_arrays([a, b], ["a", "b"]).filter(pa.array(found >= least))

    return run


def _alike(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """100 * intersection >= percent * union of two sorted sets."""
    if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
        return False
    both = np.concatenate((x, y))
    both.sort()
    shared = int(np.count_nonzero(both[1:] == both[:-1]))
    return 100 * shared >= percent * (len(both) - shared)


def _confirm(shingle: int, percent: int, most: int = 2 << 20):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = np.concatenate(([0], np.cumsum([len(p.as_buffer()) + len(q.as_buffer()) for p, q in zip(batch.column(2), batch.column(3))])))
            for i, j in words.slices(size, most):
                a, b, x, y = batch.slice(i, j - i).columns
                x, y = x.to_pylist(), y.to_pylist()
                texts = list(dict.fromkeys(x + y))
                sets = dict(zip(texts, words.exact_shingles(texts, shingle)))
                yield pa.RecordBatch.from_arrays([a, b], ["a", "b"]).filter(pa.array([_alike(sets[p], sets[q], percent) for p, q in zip(x, y)], pa.bool_()))

    return run


def _first_shared(u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """For each row of v, the first band in which it equals u; -1 for none."""
    same = (v == u).reshape(len(v), -1, ROWS).all(axis=2)
    return np.where(same.any(axis=1), same.argmax(axis=1), -1)


def _candidates(table: pa.Table, least: float, percent: int) -> Iterator[tuple[int, np.ndarray]]:
    """(i, later rows j) of the members of a bucket or of two of its blocks: of different components, meeting in this
    band first, and likely similar."""
    comp, n = table["comp"].to_numpy(), table["n"].to_numpy()
    regs, band = _matrix(table["regs"].combine_chunks()), table["band_no"][0].as_py()
    block = table["block"].to_numpy()
    cross = table["other"][0].as_py() != table["own"][0].as_py()
    for i in range(len(n)):
        j = np.arange(i + 1, len(n))
        keep = (comp[j] != comp[i]) & (100 * np.minimum(n[j], n[i]) >= percent * np.maximum(n[j], n[i]))
        if cross:
            keep &= block[j] != block[i]
        j = j[keep]
        j = j[_first_shared(regs[i], regs[j]) == band] if len(j) else j
        if len(j):
            size = np.full(len(j), float(n[i]))
            j = j[sketch.similarity(np.broadcast_to(regs[i], (len(j), regs.shape[1])), regs[j], size, n[j].astype(float), 50) >= least]
        if len(j):
            yield i, j


def _pairs(least: float, percent: int):
    """The candidate pairs of a small bucket."""

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        ids, left, right = table["rep"].to_numpy(), [], []
        for i, j in _candidates(table, least, percent):
            left.append(np.full(len(j), ids[i]))
            right.append(ids[j])
        none = np.zeros(0, np.int64)
        return pa.table({"a": np.concatenate([none, *left]), "b": np.concatenate([none, *right])})

    return run


def _involved(least: float, percent: int):
    """The members of two blocks that are in any candidate pair: rows, not pairs, leave the task."""

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        hit = np.zeros(len(table), bool)
        for i, j in _candidates(table, least, percent):
            hit[i] = hit[j] = True
        return table.filter(pa.array(hit)).select(_MEMBER)

    return run


def _links(shingle: int, least: float, percent: int):
    """Links of two blocks, confirmed on full sets of words; none between members that links found here already join."""

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        ids, comp = table["rep"].to_numpy(), table["comp"].to_numpy()
        sets = words.exact_shingles(table["words"].to_pylist(), shingle)
        root: dict[int, int] = {}

        def find(x: int) -> int:
            while root.get(x, x) != x:
                x = root[x]
            return x

        left, right = [], []
        for i, later in _candidates(table, least, percent):
            for k in later.tolist():
                if (p := find(int(comp[i]))) != (q := find(int(comp[k]))) and _alike(sets[i], sets[k], percent):
                    root[max(p, q)] = min(p, q)
                    left.append(ids[i])
                    right.append(ids[k])
        return pa.table({"a": pa.array(left, pa.int64()), "b": pa.array(right, pa.int64())})

    return run


_MEMBER = ["band", "band_no", "rep", "comp", "n", "regs", "block", "own", "other"]
_MEMBER_TYPES = "band long, band_no int, rep long, comp long, n long, regs binary, block long, own long, other long"


def near_duplicates(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, percent: int = 80, registers: int = REGISTERS
) -> DataFrame:
    """(id, n_shingles, component_id, kept) for each row of df.

    A document's set holds the distinct `shingle`-word sequences of its text, lower-cased (A-Z) and
    split at ASCII white space; a text of fewer words has its whole sequence as the one. Documents
    with 100 * intersection >= percent * union are linked; component_id is the smallest id reachable.

    1. Each text becomes its set's size, a digest of its words and SetSketch registers. Texts of equal
       words form one class, and only its smallest id goes on.
    2. Bands of four registers put classes in buckets. Every member of a bucket is paired with its
       smallest id; pairs that the joint likelihood calls similar are checked on full sets of words.
    3. Where the other members of a bucket still lie in several components, its pairs of different
       components are tested too: in one task for a small bucket, in pairs of blocks for a large one.
       Blocks carry registers only; texts go to those of their members that have a likely partner.
    A pair at the threshold shares none of the 32 bands with a probability of 5e-8. Fingerprints only propose
    pairs: links rest on words, so no collision makes one.

    Rows with null or empty text, or without words, have no set and no links. Very long texts are read whole, in
    slices. Equal rows are copies; rows of the same id are one document, linked by any of their texts. Of equally
    likely representatives the smallest id wins. Rows of null id are kept, with a null component. An empty table
    gives an empty one. Other columns of df, whatever their names, don't matter.
    """
    m = registers
    least = percent / 100 - 5 * (percent / 100 * (1 - percent / 100) / m) ** 0.5
    docs = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    table = write_table(docs.mapInArrow(_sketches(shingle, m), "id long, n long, digest binary, regs binary"), "sketches")
    made = table.where("n > 0 and id is not null")
    classes = made.groupBy("digest").agg(F.min("id").alias("rep"), F.count("*").alias("size"), F.min(F.struct("n", "regs")).alias("x"))
    classes = classes.select("digest", "rep", "size", "x.n", "x.regs")
    reps = write_table(classes, "classes")
    copies = join_hot(made.select("digest", "id"), reps.where("size > 1").select("digest", "rep", "size"), "digest", "id").where("id != rep").select(F.col("id").alias("a"), F.col("rep").alias("b"))
    bands = reps.select("rep", "n", F.posexplode(F.expr(f"transform(sequence(0, {m // ROWS - 1}), i -> xxhash64(i, substring(regs, i * {2 * ROWS} + 1, {2 * ROWS})))")).alias("band_no", "band"))
    hubs = bands.groupBy("band").agg(F.min("rep").alias("hub"), F.count("*").alias("size"), F.sum("n").alias("elements"), F.min("band_no").alias("band_no")).where("size > 1")
    hubs = write_table(hubs, "hubs")
    buckets = write_table(join_hot(bands.select("band", "rep"), hubs, "band", "rep").where("rep != hub"), "buckets")

    one = reps.select("rep", "n", "regs")
    hub = one.select(F.col("rep").alias("hub"), F.col("n").alias("n_hub"), F.col("regs").alias("regs_hub"))

    def likely(pairs: DataFrame) -> DataFrame:
        both = pairs.join(one, "rep").join(hub, "hub").where(f"100 * least(n, n_hub) >= {percent} * greatest(n, n_hub)")
        return both.select("rep", "hub", "n", "n_hub", "regs", "regs_hub").mapInArrow(_likely(least), "a long, b long")

    def words_of(ids: DataFrame) -> DataFrame:
        wanted = write_table(ids.distinct(), "wanted")
        texts = docs.where("id is not null").join(broadcast_if_small(wanted, BROADCAST_IDS), "id", "left_semi")
        return write_table(texts.mapInArrow(_normal, "id long, words binary"), "words")

    def confirmed(pairs: DataFrame) -> DataFrame:
        pairs = write_table(pairs, "pairs")
        texts = words_of(pairs.select(F.explode(F.array("a", "b")).alias("id")))
        both = pairs.join(texts.select(F.col("id").alias("a"), F.col("words").alias("x")), "a").join(texts.select(F.col("id").alias("b"), F.col("words").alias("y")), "b")
        links = write_table(both.select("a", "b", "x", "y").mapInArrow(_confirm(shingle, percent), "a long, b long"), "confirmed")
        drop_table(texts)
        drop_table(pairs)
        return links

    links = confirmed(likely(buckets.select("rep", "hub").distinct()))
    comps = write_table(connected_components(links), "components")
    placed = buckets.where("size > 2").join(comps, F.col("rep") == F.col("node"), "left").select("band", "band_no", "rep", "size", "elements", F.coalesce("component", "rep").alias("comp"))
    placed = write_table(placed, "placed")
    open_ = placed.groupBy("band").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low < high").select("band")
    members = write_table(placed.join(open_, "band", "left_semi").join(one, "rep"), "members")
    schema = "a long, b long"
    is_small = F.col("size") <= SMALL_BUCKET
    small = members.where(is_small).selectExpr("band", "band_no", "rep", "comp", "n", "regs", "0L as block", "0L as own", "0L as other")
    large = members.where(~is_small).selectExpr("*", f"cast(ceil(greatest(size / {BLOCK}, elements / {BLOCK_ELEMENTS})) as long) as blocks")
    work = members.agg(F.count_if(is_small)).first()[0], large.agg(F.sum("blocks")).first()[0] or 0
    # dealt by what there is to do: few bytes can be much work
    deal = lambda df, n, most, *by: df.repartition(max(1, -(-n // most)), *by)
    found, spent = [links, copies], [reps, hubs, buckets, comps, placed, members, links]
    if work[0]:
        more = confirmed(deal(small, work[0], TASK_MEMBERS, "band").groupBy("band").applyInArrow(_pairs(least, percent), schema))
        found.append(more)
        spent.append(more)
    if work[1]:
        pair = F.explode(F.expr("transform(sequence(0L, blocks - 1), o -> struct(least(o, block) as own, greatest(o, block) as other))"))
        large = large.withColumn("block", F.expr("pmod(xxhash64(rep), blocks)")).withColumn("pair", pair).selectExpr("band", "band_no", "rep", "comp", "n", "regs", "block", "pair.own as own", "pair.other as other")
        by = ["band", "own", "other"]
        involved = write_table(deal(large, work[1], TASK_BLOCKS * BLOCK, *by).groupBy(*by).applyInArrow(_involved(least, percent), _MEMBER_TYPES), "involved")
        with_words = involved.join(words_of(involved.select(F.col("rep").alias("id"))).withColumnRenamed("id", "rep"), "rep")
        hot = write_table(deal(with_words, involved.count(), TASK_BLOCKS * BLOCK, *by).groupBy(*by).applyInArrow(_links(shingle, least, percent), schema), "hot")
        found.append(hot)
        spent += [involved, hot]
    joined = connected_components(reduce(DataFrame.unionByName, found))
    for done in spent:
        drop_table(done)
    rows = table.select("id", "n").join(joined, F.col("id") == F.col("node"), "left")
    component = F.coalesce("component", "id")
    return rows.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))


def drop_near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, percent: int = 80) -> DataFrame:
    """Rows of df, one document of each group: that with the smallest id. Rows of null id stay."""
    return without_ids(df, id_col, near_duplicates(df, id_col, text_col, shingle, percent).where("not kept"), BROADCAST_IDS)
