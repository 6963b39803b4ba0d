"""Interval, sequence and read tables made of the driver's tables.

Each adapter is a list of expressions that Spark and DuckDB read alike, so a query and its SQL
start from the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from spanloom.operators.seqops import chunks
from spanloom.session import spread

LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
BASES = ("ACGT" * 7)[:26] * 2
_DNA = f"translate(regexp_replace(text, '[^A-Za-z]+', '', 'g'), '{LETTERS}', '{BASES}')"

ADAPTERS: dict[str, tuple[str, list[str]]] = {
    "gff": (
        "lineitem",
        [
            "concat('chr', cast(l_suppkey % 5 + 1 as varchar(9))) as sequence",
            "'sim' as source",
            "l_returnflag as feature",
            "l_partkey * 10 + l_linenumber as start",
            "l_partkey * 10 + l_linenumber + cast(l_quantity as bigint) - 1 as stop",
            "l_extendedprice as score",
            "case when l_linestatus = 'O' then '+' else '-' end as strand",
            "cast(l_quantity as bigint) as c",
            "cast(l_linenumber as bigint) as t",
            "concat('AT', cast(l_orderkey as varchar(20))) as id",
            "cast(l_linenumber as bigint) as ln",
        ],
    ),
    "genes": (
        "part",
        [
            "concat('chr', cast(p_partkey % 5 + 1 as varchar(9))) as sequence",
            "concat('AT', cast(p_partkey as varchar(20))) as locus",
            "p_partkey * 10 as start",
            "p_partkey * 10 + p_size * 5 as stop",
            "case when p_partkey % 2 = 0 then '+' else '-' end as strand",
        ],
    ),
    "sites": (
        "orders",
        [
            "concat('chr', cast(o_custkey % 5 + 1 as varchar(9))) as sequence",
            "o_orderkey * 3 as start",
            "o_orderkey * 3 as stop",
            "cast(floor(o_totalprice) as bigint) % 40 as c",
            "o_custkey % 30 as t",
            "case o_orderkey % 3 when 0 then 'CG' when 1 then 'CHG' else 'CHH' end as context",
            "case when o_orderkey % 2 = 0 then '+' else '-' end as strand",
            "concat('AT', cast(o_orderkey as varchar(20))) as id",
            "cast(1 as bigint) as ln",
            "round(cast(cast(floor(o_totalprice) as bigint) % 40 as double) / (cast(floor(o_totalprice) as bigint) % 40 + o_custkey % 30 + 1), 6) as score",
        ],
    ),
    "sites_b": (
        "orders",
        [
            "concat('chr', cast(o_custkey % 5 + 1 as varchar(9))) as sequence",
            "o_orderkey * 3 as start",
            "o_orderkey * 3 as stop",
            "cast(floor(o_totalprice) as bigint) % 23 as c",
            "o_custkey % 17 as t",
            "round(cast(cast(floor(o_totalprice) as bigint) % 23 as double) / (cast(floor(o_totalprice) as bigint) % 23 + o_custkey % 17 + 1), 6) as score",
        ],
    ),
    "exons": (
        "lineitem",
        [
            "concat('chr', cast(l_orderkey % 5 + 1 as varchar(9))) as sequence",
            "concat('AT', cast(l_orderkey as varchar(20))) as locus",
            "concat(concat('AT', cast(l_orderkey as varchar(20))), case when l_linenumber % 2 = 0 then '.2' else '.1' end) as isoform",
            "l_orderkey * 100 + l_linenumber * 60 as start",
            "l_orderkey * 100 + l_linenumber * 60 + cast(l_quantity as bigint) as stop",
            "case when l_orderkey % 2 = 0 then '+' else '-' end as strand",
        ],
    ),
    "fasta": ("documents", ["concat('S', cast(doc_id as varchar(20))) as seq_id", f"{_DNA} as seq"]),
    "hits_a": (
        "lineitem",
        [
            "concat('R', cast(l_orderkey as varchar(20))) as \"read\"",
            "concat('chr', cast(l_suppkey % 3 + 1 as varchar(9))) as chrom",
            "l_partkey * 7 as coord",
            "cast(l_linenumber - 1 as bigint) as hit",
            "cast(l_quantity as bigint) % 3 as mismatches",
            "case when l_linestatus = 'O' then '+' else '-' end as strand",
            "cast(36 as bigint) as length",
            "cast(20000 as bigint) as chrom_length",
        ],
    ),
    "hits_b": (
        "lineitem",
        [
            "concat('R', cast(l_orderkey + l_linenumber % 2 as varchar(20))) as \"read\"",
            "concat('chr', cast(l_suppkey % 3 + 1 as varchar(9))) as chrom",
            "20000 - l_partkey * 7 + l_linenumber * 40 as coord",
            "cast(l_linenumber - 1 as bigint) as hit",
            "cast(l_quantity as bigint) % 2 as mismatches",
            "case when l_linestatus = 'O' then '-' else '+' end as strand",
            "cast(36 as bigint) as length",
            "cast(20000 as bigint) as chrom_length",
        ],
    ),
    # whole texts, cut into reads of 40 bases one behind the other
    "reads": (
        "tiles",
        [
            "concat('r', cast(doc_id as varchar(20)), case when k > 0 then concat('_', cast(k as varchar(20))) else '' end) as name",
            "bases",
            "target",
            "concat('chr', cast(doc_id % 4 + 1 as varchar(9))) as sequence",
            "(doc_id - doc_id % 4) * 50 + k * 40 + 1 as start",
            "(doc_id - doc_id % 4) * 50 + k * 40 + 1 + length(bases) as stop",
            "case when doc_id % 2 = 0 then '+' else '-' end as strand",
            "cast(doc_id % 2 + 1 as int) as read_no",
            "cast(4000000000 as bigint) as length",
        ],
    ),
    "lists": ("labels", ["concat('AT', cast(doc_id as varchar(20))) as id", "cast(quality as double) as list_score", "cast(toxic as int) as toxic", "doc_id as ordinal"]),
}


#: Bases of a read that is cut from a text.
TILE = 40
#: The documents' bases with a row for each run of TILE (k, from 0): the run, and it with two more bases on either side. For DuckDB.
_TILES = (
    f"(select doc_id, k, substr(dna, k * {TILE} + 1, {TILE}) as bases, substr('NN' || dna || 'NN', k * {TILE} + 1, 4 + length(substr(dna, k * {TILE} + 1, {TILE}))) as target"
    f" from (select doc_id, dna, unnest(range(0, greatest(length(dna) - 1, 0) // {TILE} + 1)) as k from (select doc_id, {_DNA} as dna from documents where text is not null) y) z) tiles"
)


def _tiles(docs: DataFrame) -> DataFrame:
    """The same rows: pieces of the padded bases, so the work is in proportion to a text's length."""
    cut = chunks(docs.where("text is not null").selectExpr("doc_id as seq_id", f"concat('NN', {_portable(_DNA)}, 'NN') as seq"), TILE, 4)
    runs = cut.where("at = 1 or length(part) > 4")
    return runs.selectExpr("seq_id as doc_id", f"cast(at - 1 as bigint) div {TILE} as k", "substring(part, 3, length(part) - 4) as bases", "part as target")


def _portable(text: str) -> str:
    return text.replace(", 'g')", ")").replace('"read"', "`read`")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """An adapter's table, or one of the driver's."""
    if name not in ADAPTERS:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    base, columns = ADAPTERS[name]
    if base == "tiles":
        rows = _tiles(spread(spark.read.parquet(f"{sf_dir}/documents.parquet"), by_place=True))
    else:
        rows = spread(spark.read.parquet(f"{sf_dir}/{base}.parquet"), by_place=True)
    return rows.selectExpr(*map(_portable, columns))


def with_sql(*names: str) -> str:
    """The adapters as common table expressions for DuckDB."""
    base = lambda n: _TILES if ADAPTERS[n][0] == "tiles" else ADAPTERS[n][0]
    return "with " + ", ".join(f"{n} as (select {', '.join(ADAPTERS[n][1])} from {base(n)})" for n in names)
