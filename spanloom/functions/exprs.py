"""Column expressions over intervals, sequences, attributes and scores."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x: Column | str | None) -> Column | None:
    return F.col(x) if isinstance(x, str) else x


def span_length(start="start", stop="stop") -> Column:
    """Number of bases of a closed interval."""
    return _c(stop) - _c(start) + 1


def before(stop_a, start_b) -> Column:
    return _c(stop_a) < _c(start_b)


def after(start_a, stop_b) -> Column:
    return _c(start_a) > _c(stop_b)


def overlaps(start_a, stop_a, start_b, stop_b) -> Column:
    return (_c(start_a) <= _c(stop_b)) & (_c(stop_a) >= _c(start_b))


def overlap_size(start_a, stop_a, start_b, stop_b) -> Column:
    """Bases that two closed intervals share; 0 if disjoint."""
    return F.greatest(F.lit(0).cast("long"), F.least(_c(stop_a), _c(stop_b)) - F.greatest(_c(start_a), _c(start_b)) + 1)


def overlap_ratio(start_a, stop_a, start_b, stop_b) -> Column:
    """Shared bases as a share of the second interval."""
    return overlap_size(start_a, stop_a, start_b, stop_b) / span_length(start_b, stop_b)


def attribute(text, tag: str) -> Column:
    """The value of a tag in an attribute string; else the first `;` token; `.` becomes null."""
    tagged = F.regexp_extract(_c(text), tag + r"[=\s]?([^;,]+)", 1)
    value = F.when(tagged != "", tagged).otherwise(F.split(_c(text), ";")[0])
    return F.nullif(F.translate(value, "\"\t\r\n", ""), F.lit("."))


def attribute_map(text) -> Column:
    """Tokens `key=value` between semicolons, both sides trimmed; a bare token is the value of Note.

    The last of equal keys wins, and a trailing `*` of the whole string is no part of it."""
    cut = F.filter(F.split(F.regexp_replace(_c(text), r"\*$", ""), ";"), lambda x: _bare(x) != "")

    def entry(x: Column) -> Column:
        key = F.when(x.contains("="), _bare(F.substring_index(x, "=", 1))).otherwise("Note")
        # between the first and the second `=`; all of a bare token
        value = _bare(F.substring_index(F.substring_index(x, "=", 2), "=", -1))
        return F.struct(key.alias("k"), value.alias("v"))

    def last_wins(e: Column) -> Column:
        later = lambda x, i: F.exists(F.slice(e, i + 2, F.size(e)), lambda y: y["k"] == x["k"])
        keys = e["k"]
        return F.when(F.size(F.array_distinct(keys)) == F.size(e), e).otherwise(F.filter(e, lambda x, i: ~later(x, i)))

    # an array of one binds the entries, so they are made once
    found = F.transform(F.array(F.transform(cut, entry)), last_wins)[0]
    return F.coalesce(F.map_from_entries(found), F.create_map().cast("map<string,string>"))


def _bare(x: Column) -> Column:
    return F.btrim(x, F.lit(" \t\r\n"))


def has_asterisk(text) -> Column:
    return F.coalesce(_c(text).rlike(r"\*$"), F.lit(False))


def locus_prefix(locus) -> Column:
    return F.regexp_extract(_c(locus), r"([^.]+)(?:\.([^.]+))?", 1)


def locus_suffix(locus) -> Column:
    return F.nullif(F.regexp_extract(_c(locus), r"([^.]+)\.([^.]+)", 2), F.lit(""))


def reverse_complement(seq) -> Column:
    return F.reverse(F.translate(_c(seq), "ACGTacgt", "TGCAtgca"))


def c_to_t(seq) -> Column:
    return F.translate(_c(seq), "cC", "tT")


def g_to_a(seq) -> Column:
    return F.translate(_c(seq), "gG", "aA")


def subsequence(seq, start, stop, reverse: bool = False) -> Column:
    """Bases start..stop, counted from 1, or from the end if negative; null out of bounds."""
    n = F.length(_c(seq))
    a = F.when(_c(start) < 0, n + _c(start) + 1).otherwise(_c(start))
    b = F.when(_c(stop) < 0, n + _c(stop) + 1).otherwise(_c(stop))
    part = F.substring(_c(seq), a.cast("int"), (b - a + 1).cast("int"))
    return F.when((a >= 1) & (b <= n) & (a <= b), reverse_complement(part) if reverse else part)


def flip(x, length) -> Column:
    """A coordinate on the other strand."""
    return _c(length) + 1 - _c(x)


def solexa_to_sanger(quality) -> Column:
    """A Sanger quality string from Solexa characters: chr(int(33 + 10 * log10(1 + 10^(q / 10)) + 0.499))."""
    q = lambda ch: (F.ascii(ch) - 64).cast("double")
    return F.array_join(F.transform(F.split(_c(quality), ""), lambda ch: F.when(ch == "", F.lit("")).otherwise(F.chr(F.floor(33 + 10 * F.log10(1 + F.pow(F.lit(10.0), q(ch) / 10)) + 0.499)))), "")


def solexa_numbers_to_sanger(numbers) -> Column:
    """The same from blank-separated numbers."""
    return F.array_join(F.transform(F.split(F.trim(_c(numbers)), r"\s+"), lambda x: F.chr(F.floor(33 + 10 * F.log10(1 + F.pow(F.lit(10.0), x.cast("double") / 10)) + 0.499))), "")


def pair_distance(left, right, right_length, single_ended: bool = False, left_length=None) -> Column:
    """Distance of two mates: with opposite strands |(length - left + 1) - right|, else |left - right| less the
    left read, and not under 0."""
    if single_ended:
        return F.greatest(F.lit(0).cast("long"), F.abs(_c(left) - _c(right)) - _c(left_length))
    return F.abs((_c(right_length) - _c(left) + 1) - _c(right))


def mismatch_class(ranks) -> Column:
    """Mismatches of a unique best hit: the place of the first rank that is exactly 1, from 0; null for none."""
    return F.nullif(F.array_position(_c(ranks), F.lit(1)).cast("int") - 1, F.lit(-1))


def centre_distance(start, stop, locus_start, locus_stop, strand) -> tuple[Column, Column, Column]:
    """Distances of an interval's centre to a locus's 5' and 3' ends, and whether the locus spans it."""
    centre = F.floor((_c(start) + _c(stop)) / 2)
    five = F.when(_c(strand) == "-", _c(locus_stop)).otherwise(_c(locus_start))
    three = F.when(_c(strand) == "-", _c(locus_start)).otherwise(_c(locus_stop))
    return F.abs(centre - five), F.abs(centre - three), (centre >= _c(locus_start)) & (centre <= _c(locus_stop))


def log2_ratio(a, b) -> Column:
    """log2(a / b); null where a value is missing or not positive."""
    return F.when((_c(a) > 0) & (_c(b) > 0), F.log2(_c(a) / _c(b)))


def combine_scores(a, b, how: str) -> Column:
    ways = {"log2": log2_ratio(a, b), "difference": _c(a) - _c(b), "product": _c(a) * _c(b)}
    return ways[how]


def compare_scores(a, b, how: str = "sub", reverse: bool = False) -> Column:
    x, y = (_c(b), _c(a)) if reverse else (_c(a), _c(b))
    return x - y if how == "sub" else F.try_divide(x, y)


def inverse_log(p, base: float | None = None) -> Column:
    """1 / ln(p) or 1 / log_base(p); p itself where it is 0 or 1."""
    log = F.log(_c(p)) if base is None else F.log(_c(p)) / F.log(F.lit(float(base)))
    return F.when(_c(p).isin(0.0, 1.0), _c(p)).otherwise(1 / log)


def snp_notation(a, b) -> Column:
    return F.concat(_c(a), F.lit(">"), _c(b))


def snp_parts(text) -> tuple[Column, Column]:
    parts = F.split(_c(text), ">")
    return parts[0], F.get(parts, F.lit(1))


def read_parts(feature) -> tuple[Column, Column, Column]:
    """Pair id, read number and bases of a feature written id/N:BASES."""
    return tuple(F.regexp_extract(_c(feature), r"^([^/]+)/(\d+):([ACGTNacgtn]+)$", k) for k in (1, 2, 3))


def context(seq, i, reverse: bool = False) -> Column:
    """CG, CHG or CHH of the cytosine at place i (from 1) of seq; with reverse, of the guanine on the other strand."""
    at = lambda k: F.substring(_c(seq), (i + k).cast("int"), 1)
    near, far, base = (at(-1), at(-2), "C") if reverse else (at(1), at(2), "G")
    return F.when(near == base, "CG").when(far == base, "CHG").otherwise("CHH")


def format_g(x) -> Column:
    """A number as %g writes it: six significant digits, no trailing zeros, an exponent
    under -4 or over 5. Halves of the shortest decimal form are rounded up."""
    x = _c(x).cast("double")

    def spelled(d: Column) -> Column:
        """From d = -d.ddddde+ee: the six digits with a point moved to its place."""
        m = F.translate(F.regexp_extract(d, r"^-?([0-9.]+)e", 1), ".", "")
        e = F.regexp_extract(d, r"e([+-]\d+)$", 1).try_cast("int")
        strip = lambda t: F.regexp_replace(t, r"[.]?0*$", "")
        part = lambda a, n: F.substring(m, a, n)
        wide = F.concat(strip(F.concat(part(F.lit(1), F.lit(1)), F.lit("."), part(F.lit(2), F.lit(9)))), F.regexp_extract(d, r"(e[+-]\d+)$", 1))
        plain = F.when(e >= 0, F.concat(part(F.lit(1), e + 1), F.lit("."), part(e + 2, F.lit(9)))).otherwise(F.concat(F.lit("0."), F.repeat(F.lit("0"), -e - 1), m))
        return F.concat(F.when(d.startswith("-"), "-").otherwise(""), F.when((e < -4) | (e >= 6), wide).otherwise(strip(plain)))

    # an array of one binds the digits, so they are written once
    text = F.transform(F.array(F.format_string("%.5e", x)), spelled)[0]
    return F.when(x.isNotNull(), F.when(x == 0, F.lit("0")).otherwise(text))
