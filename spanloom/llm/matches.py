"""Places of regular-expression matches in whole texts, with built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Matches whose places are added up in one run; longer lists are added up run by run.
RUN = 256
LEFT, RIGHT = 24, 4


def add_matches(df: DataFrame, text: str, name: str, regex: str) -> DataFrame:
    """df with the array `name` of a text's leftmost non-overlapping matches in order, each a struct of
    start and end (in characters, end exclusive), the match m, and the characters to its left and right.

    The pieces between matches give the places: each match starts after all pieces and matches before
    it. Every step is a built-in function, and the work is in proportion to the length of the text."""
    m, g, n, c, p, s = (f"__{name}_{x}" for x in "mgncps")
    df = df.withColumn(m, F.regexp_extract_all(text, F.lit(regex), F.lit(0)))
    df = df.withColumn(g, F.when(F.size(m) > 0, F.split(text, regex, -1)).otherwise(F.array().cast("array<string>")))
    df = df.withColumn(n, F.expr(f"transform({m}, (x, i) -> length({g}[i]) + length(x))"))
    # sums of runs, then what stands before each run, then what stands before each match
    df = df.withColumn(c, F.expr(f"transform(sequence(0, (size({n}) + {RUN - 1}) div {RUN}), r -> aggregate(slice({n}, int(r) * {RUN} + 1, {RUN}), 0, (a, x) -> a + x))"))
    df = df.withColumn(p, F.expr(f"aggregate({c}, array(0), (a, x) -> concat(a, array(element_at(a, -1) + x)))"))
    df = df.withColumn(s, F.expr(f"flatten(transform(sequence(0, (size({n}) + {RUN - 1}) div {RUN}), r -> slice(aggregate(slice({n}, int(r) * {RUN} + 1, {RUN}), array({p}[int(r)]), (a, x) -> concat(a, array(element_at(a, -1) + x))), 1, size(slice({n}, int(r) * {RUN} + 1, {RUN})))))"))
    place = f"{s}[i] + length({g}[i])"
    df = df.withColumn(name, F.expr(f"transform({m}, (x, i) -> named_struct('start', {place}, 'end', {place} + length(x), 'm', x, 'left', right({g}[i], {LEFT}), 'right', left({g}[i + 1], {RIGHT})))"))
    return df.drop(m, g, n, c, p, s)


def spelled(spans: str) -> Column:
    """kind:start:end of each struct of an array, comma-joined in the array's order."""
    return F.expr(f"array_join(transform({spans}, x -> concat_ws(':', x.kind, x.start, x.end)), ',')")


def leading(array: str, test: str) -> str:
    """SQL of how many elements e of an array fulfil a test of `e`, where those that do come first: a binary search."""
    mid = "shiftright(bs.lo + bs.hi, 1)"
    return (
        f"aggregate(sequence(1, cast(log2(size({array}) + 1) as int) + 1), named_struct('lo', 0, 'hi', size({array})), (bs, bk) -> case when bs.lo >= bs.hi then bs"
        f" when element_at(transform(array({array}[{mid}]), e -> {test}), 1) then named_struct('lo', {mid} + 1, 'hi', bs.hi) else named_struct('lo', bs.lo, 'hi', {mid}) end, bs -> bs.lo)"
    )


def inside_one(arrays: list[str], start: str, end: str) -> str:
    """Whether a span of any of the arrays (each in order, without overlaps) holds the place from start to end."""
    return " or ".join(_last_one(a, f"e.start <= {start}", f"o.end >= {end}") for a in arrays)


def meets_one(arrays: list[str], start: str, end: str) -> str:
    """Whether a span of any of the arrays (each in order, without overlaps) shares a character with that place."""
    return " or ".join(_last_one(a, f"e.start < {end}", f"o.end > {start}") for a in arrays)


def _last_one(array: str, test: str, then: str) -> str:
    return f"element_at(transform(array({leading(array, test)}), n -> case when n = 0 then false else element_at(transform(array({array}[n - 1]), o -> {then}), 1) end), 1)"


def before_each(array: str, value: str, nothing: str) -> str:
    """SQL of an array: for each element the greatest `value` (of an element x) of those before it, `nothing` for the
    first. Runs of RUN elements are gone through one by one, so no array grows with each step."""
    runs = f"sequence(0, (size({array}) + {RUN - 1}) div {RUN})"
    own = f"slice({array}, int(br) * {RUN} + 1, {RUN})"
    heads = f"aggregate(transform({runs}, br -> aggregate({own}, {nothing}, (ba, x) -> greatest(ba, {value}))), array({nothing}), (bh, bv) -> concat(bh, array(greatest(element_at(bh, -1), bv))))"
    steps = f"slice(aggregate({own}, array(bt[int(br)]), (ba, x) -> concat(ba, array(greatest(element_at(ba, -1), {value})))), 1, size({own}))"
    return f"element_at(transform(array({heads}), bt -> flatten(transform({runs}, br -> {steps}))), 1)"


#: Characters of a block of a text that is cut: a place is looked for in its block, not from the start of the text.
BLOCK = 1024


def cut_out(text: str, spans: str, mark: str) -> Column:
    """The text with each of the spans (sorted by start; overlapping ones are joined) replaced by mark.

    A span that starts behind the end of all before it begins a stretch to be replaced; the result is put together from
    the parts between these, which are taken from blocks of the text, so the work is in proportion to text and spans."""
    part = (
        f"case when {{0}} >= {{1}} then '' else array_join(transform(sequence({{0}} div {BLOCK}, ({{1}} - 1) div {BLOCK}), cb -> "
        f"substring(c.blocks[int(cb)], int(greatest({{0}} - cb * {BLOCK}, 0) + 1), int(least({{1}} - cb * {BLOCK}, {BLOCK}) - greatest({{0}} - cb * {BLOCK}, 0)))), '') end"
    )
    own = f"transform({spans}, x -> named_struct('start', x.start, 'end', x.end))"
    bound = f"named_struct('blocks', regexp_extract_all({text}, '(?s).{{1,{BLOCK}}}', 0), 'spans', {own}, 'ends', {before_each(spans, 'x.end', '0')}, 'size', length({text}), 'last', array_max(transform({spans}, x -> x.end)))"
    stretches = "filter(transform(c.spans, (x, i) -> named_struct('start', x.start, 'before', c.ends[i], 'i', i)), x -> x.i = 0 or x.start > x.before)"
    body = f"concat(array_join(transform({stretches}, x -> concat({part.format('x.before', 'x.start')}, '{mark}')), ''), {part.format('c.last', 'c.size')})"
    return F.expr(f"case when size({spans}) = 0 then {text} else element_at(transform(array({bound}), c -> {body}), 1) end")
