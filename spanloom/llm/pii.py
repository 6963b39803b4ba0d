"""Personal data: high-recall generators, boosted trees over format and context, thresholds.

The search over documents uses built-in DataFrame functions only. The trees are trained on the
driver from lines made by rule and become one SQL expression.
"""

from __future__ import annotations

import warnings
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanloom.llm import boosting
from spanloom.llm.learn import logistic
from spanloom.llm.matches import LEFT, add_matches, cut_out, leading, meets_one

KINDS = ("email", "ip", "card", "phone")
#: The stated patterns. Possessive quantifiers and a look behind keep Java from trying every start of a
#: run again and from recursing; where each pattern ends, giving characters back can't help a match.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
#: Generators of candidates beyond the stated patterns: mail addresses in disguise, tokens of digits (of which every
#: window of one to WINDOW tokens in a row is a candidate), and the usual forms of cards, phone and social security numbers.
_AT = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+\x20?[\[({]?\x20?(?:@|\bat\b)\x20?[\])}]?\x20?[A-Za-z0-9-]{1,63}"
_DOT = r"(?:\x20?[\[({]?\x20?(?:\.|\bdot\b)\x20?[\])}]?\x20?[A-Za-z0-9-]{1,63})"
PARTS, WINDOW = 8, 6
DISGUISED = f"(?i){_AT}{_DOT}{{1,{PARTS}}}"
TOKEN = r"(?:[+(]{1,2}|(?<![0-9A-Za-z.+(]))[0-9][0-9()+.-]*+"
FORMS = {
    2: r"(?<![0-9])(?:[0-9]{4}[\x20-]?[0-9]{4}[\x20-]?[0-9]{4}[\x20-]?[0-9]{1,7}|3[47][0-9]{2}[\x20-]?[0-9]{6}[\x20-]?[0-9]{5})(?![0-9])",
    3: r"(?<![0-9A-Za-z])(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9A-Za-z])",
    4: r"(?<![0-9A-Za-z])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z])",
}
#: Kinds of candidates, by the number that sorts them among the spans.
ADDED = {0: "email", 2: "card", 3: "phone", 4: "ssn"}
#: Lines made by rule that the trees are trained on.
MADE = 1600
PRECISION = 0.98

_DIGITS = "regexp_replace(c.m, '[^0-9]', '')"
_COUNT = "length(c.m) - length(replace(c.m, '{}', ''))"
#: Features of a candidate c, by name: format first, then context.
FEATURES = {
    "kind": "c.kind",
    "size": "length(c.m)",
    "digits": f"length({_DIGITS})",
    "letters": "length(regexp_replace(c.m, '[^A-Za-z]', ''))",
    "dots": _COUNT.format("."),
    "hyphens": _COUNT.format("-"),
    "blanks": _COUNT.format(" "),
    "slashes": _COUNT.format("/"),
    "parens": _COUNT.format("("),
    "ats": _COUNT.format("@"),
    "bracketed": r"int(c.m rlike '[\\[({]\\x20?(?i:at|dot|@)')",
    "us_shape": r"int(c.m rlike '^[(]?[0-9]{3}[)]?[-. ]*[0-9]{3}[-. ]+[0-9]{4}$')",
    "token_groups": r"size(split(c.m, '[^0-9]+'))",
    "domain": r"int(c.m rlike '(?i)[. ](?:com|org|net|edu|gov|info|io|de|fr|es|uk)$')",
    "sentence": r"int(c.m rlike '[.] [A-Z]')",
    "says_dot": r"int(c.m rlike '(?i)[^a-z]dot[^a-z]')",
    "after_digits": r"int(c.left rlike '[0-9][ ./-]{1,3}$')",
    "before_digits": r"int(c.right rlike '^[ ./-]{1,3}[(+]?[0-9]')",
    "id_shape": r"int(c.m rlike '^[0-9]{3}-[0-9]{2}-[0-9]{4}$')",
    "date_shape": r"int(c.m rlike '^[0-9]{1,4}[-/.][0-9]{1,2}[-/.][0-9]{1,4}$')",
    "tail": r"length(regexp_extract(c.m, '[. ]([A-Za-z]+)$', 1))",
    "left_word": r"int(c.left rlike '[A-Za-z0-9]$')",
    "right_word": r"int(c.right rlike '^[A-Za-z0-9]')",
    "says_phone": r"int(c.left rlike '(?i)(phone|tel|mobile|cell|fax|call|whatsapp)')",
    "says_mail": r"int(c.left rlike '(?i)(mail|contact|write|reach)')",
    "says_id": r"int(c.left rlike '(?i)(ssn|social|passport|tax|license)')",
    "says_other": r"int(c.left rlike '(?i)(version|order|invoice|isbn|page|pp|no[.]|id|code|zip|#)')",
}


@dataclass
class Model:
    trees: boosting.Trees
    #: The probability from which a candidate of each kind in ADDED is a span.
    thresholds: dict[int, float]


def _digits_of(x: str) -> str:
    return f"regexp_replace({x}, '[^0-9]', '')"


def _luhn(d: str) -> str:
    """Whether a string of digits passes Luhn: every second digit from the right doubled, less 9 above 9."""
    digit = f"(ascii(substring({d}, length({d}) - i, 1)) - 48)"
    return f"(aggregate(sequence(0, length({d}) - 1), 0, (a, i) -> a + case when i % 2 = 0 then {digit} when {digit} > 4 then 2 * {digit} - 9 else 2 * {digit} end) % 10 = 0)"


_BYTE = "^0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"
#: What a match must also be, as SQL of its text.
_PASS = {
    "email": lambda m: "true",
    "ip": lambda m: f"forall(split({m}, '[.]'), o -> o rlike '{_BYTE}')",
    "card": lambda m: f"case when length({_digits_of(m)}) between 13 and 19 then {_luhn(_digits_of(m))} else false end",
    "phone": lambda m: f"length({_digits_of(m)}) between 9 and 15",
}


def _base(df: DataFrame, text: str) -> DataFrame:
    """df with an array of structs (no, kind, start, end) for each kind that the stated patterns find."""
    for no, (kind, regex) in enumerate(zip(KINDS, (EMAIL, IP, CARD, PHONE))):
        # too short runs of digits can't pass: they are left out by the pattern, at the same places
        if kind == "card":
            regex = r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){12,}+"
        df = add_matches(df, text, f"__{kind}", regex)
        df = df.withColumn(f"__{kind}", F.expr(f"transform(filter(__{kind}, x -> {_PASS[kind]('x.m')}), x -> named_struct('no', {no}, 'kind', '{kind}', 'start', x.start, 'end', x.end))"))
    return df.withColumn("__base", F.expr("concat(" + ", ".join(f"__{k}" for k in KINDS) + ")"))


def _windows(tokens: str) -> str:
    """Every window of one to WINDOW tokens in a row as a candidate, as SQL of an array of tokens with `near`:
    that only blanks or separators stand between a token and the one before. A window ends at its last digit, and
    begins after a bracket that isn't closed in it."""
    joined = f"array_join(transform(sequence(i, i + k), j -> case when j = i then {tokens}[j].m else concat({tokens}[j].gap, {tokens}[j].m) end), '')"
    windows = f"transform(filter(sequence(0, least({WINDOW - 1}, size({tokens}) - 1 - i)), k -> k = 0 or forall(sequence(i + 1, i + k), j -> {tokens}[j].near)), k -> named_struct('w', {joined}, 'end', {tokens}[i + k].end, 'right', {tokens}[i + k].right))"
    upto = "transform({0}, x -> named_struct('w', regexp_extract(x.w, '^.*[0-9]', 0), 'right', left(concat(regexp_extract(x.w, '[^0-9]*$', 0), x.right), 4)))"
    begun = r"transform({0}, x -> named_struct('skip', length(x.w) - length(regexp_replace(x.w, '^[+(]*[(](?=[^)]*$)', '')), 'm', regexp_replace(x.w, '^[+(]*[(](?=[^)]*$)', ''), 'right', x.right))"
    named = f"transform({begun.format(upto.format(windows))}, x -> named_struct('kind', case when {_PASS['card']('x.m')} then 2 when x.m rlike '^[0-9]{{3}}-[0-9]{{2}}-[0-9]{{4}}$' then 4 else 3 end, 'start', t.start + x.skip, 'end', t.start + x.skip + length(x.m), 'm', x.m, 'left', t.left, 'right', x.right))"
    fits = f"length({_digits_of('x.m')}) between 7 and case x.kind when 2 then 19 else 15 end and not x.right rlike '^[0-9A-Za-z]'"
    return f"flatten(transform({tokens}, (t, i) -> filter({named}, x -> {fits})))"


def _candidates(df: DataFrame, text: str) -> DataFrame:
    """df with the array __found of generated candidates, which may overlap, with their features."""
    df = add_matches(add_matches(df, text, "__mail", DISGUISED), text, "__runs", TOKEN)
    # a disguised address may run on into the next sentence: every shorter chain of parts is a candidate too
    chains = ", ".join(f"regexp_extract(x.m, '(?i)^{_AT}{_DOT}{{{k}}}(?![A-Za-z0-9-])', 0)".replace("\\", "\\\\") for k in range(1, PARTS + 1))
    df = df.withColumn("__mail", F.expr(f"flatten(transform(__mail, x -> transform(filter(array_distinct(array({chains}, x.m)), m -> m <> ''), m -> named_struct('kind', 0, 'start', x.start, 'end', x.start + length(m), 'm', m, 'left', x.left, 'right', left(concat(substring(x.m, length(m) + 1), x.right), 4)))))"))
    # what stands before a token goes on to the left of the tokens before it
    before = "concat(" + ", ".join(f"case when i >= {k} then concat(__runs[i - {k}].left, __runs[i - {k}].m) else '' end" for k in (3, 2, 1)) + ", x.left)"
    near = r"i > 0 and x.start - __runs[i - 1].end <= 3 and x.left rlike '^[ /.-]{1,3}$'"
    df = df.withColumn("__tokens", F.expr(f"transform(__runs, (x, i) -> named_struct('start', x.start, 'end', x.end, 'm', x.m, 'gap', x.left, 'near', {near}, 'left', right({before}, {LEFT}), 'right', left(concat(x.right, case when i + 1 < size(__runs) then __runs[i + 1].m else '' end), 4)))"))
    df = df.withColumn("__windows", F.expr(_windows("__tokens")))
    for kind, regex in FORMS.items():
        df = add_matches(df, text, f"__form{kind}", regex)
        df = df.withColumn(f"__form{kind}", F.expr(f"transform({'filter(__form2, x -> ' + _PASS['card']('x.m') + ')' if kind == 2 else f'__form{kind}'}, x -> named_struct('kind', {kind}, 'start', x.start, 'end', x.end, 'm', x.m, 'left', x.left, 'right', x.right))"))
    df = df.withColumn("__all", F.concat("__mail", "__windows", *[f"__form{k}" for k in FORMS]))
    features = ", ".join(f"'{k}', double({v})" for k, v in FEATURES.items() if k != "kind")
    apart = f"filter(__all, c -> not ({meets_one([f'__{k}' for k in KINDS], 'c.start', 'c.end')}))"
    return df.withColumn("__found", F.expr(f"transform({apart}, c -> named_struct('kind', c.kind, 'start', c.start, 'end', c.end, {features}))"))


def _best(found: str) -> str:
    """The best of overlapping candidates, as SQL of an array of them, sorted by start and end, of structs that sort best first: a
    candidate is taken if no better one that is taken overlaps it.

    In each round the candidates that are better than all undecided ones that they overlap are taken, and what overlaps a taken one
    is dropped, until all are decided. A candidate looks at those that start at most the longest one's length before it."""
    size = "array_max(transform(f.x, y -> y.end - y.start))"
    near = f"transform(f.x, (x, i) -> named_struct('lo', {leading('f.x', 'e.start <= x.start - z')}, 'hi', {leading('f.x', 'e.start < x.end')}))"
    # a place's state: 0 undecided, 1 taken, 2 dropped
    others = "filter(sequence(g.near[i].lo, g.near[i].hi - 1), j -> j <> i and g.x[j].start < x.end and x.start < g.x[j].end)"
    state = f"case when st[i] <> 0 then st[i] else element_at(transform(array({others}), o -> case when exists(o, j -> st[j] = 1) then 2 when exists(o, j -> st[j] = 0 and (g.x[j] < x or (g.x[j] = x and j < i))) then 0 else 1 end), 1) end"
    step = f"element_at(transform(array(transform(g.x, (x, i) -> {state.replace('st[', 'r.st[')})), t -> named_struct('st', t, 'open', exists(t, v -> v = 0))), 1)"
    rounds = f"aggregate(sequence(1, size(g.x)), named_struct('st', transform(g.x, x -> 0), 'open', true), (r, k) -> case when r.open then {step} else r end, r -> r.st)"
    taken = f"element_at(transform(array({rounds}), st -> filter(g.x, (x, i) -> st[i] = 1)), 1)"
    bound = f"element_at(transform(array({size}), z -> {near}), 1)"
    body = f"element_at(transform(array(named_struct('x', f.x, 'near', {bound})), g -> {taken}), 1)"
    return f"case when size({found}) = 0 then {found} else element_at(transform(array(named_struct('x', {found})), f -> {body}), 1) end"


def _made(seed: int = 23) -> list[tuple[str, list[tuple[int, int]]]]:
    """Lines made by rule with the places of personal data in them: several formats and contexts, alone, behind other
    numbers and in lists; and lines of other numbers and words, without any."""
    rng = np.random.default_rng(seed)
    d = lambda n: "".join(map(str, rng.integers(0, 10, n)))
    word = lambda: "".join(rng.choice(list("abcdefghijklmnoprstuvw"), rng.integers(2, 9)))
    pick = lambda *x: x[int(rng.integers(0, len(x)))]

    def number(valid: bool, size: int = 16) -> str:
        while True:
            n = pick("4", "5", "3", "6") + d(size - 1)
            if (sum(int(c) if k % 2 == 0 else sum(map(int, str(2 * int(c)))) for k, c in enumerate(reversed(n))) % 10 == 0) == valid:
                return n

    def grouped(n: str) -> str:
        return pick("", " ", "-").join(n[k : k + 4] for k in range(0, len(n), 4))

    tld = lambda: pick("com", "org", "net", "de", "edu", "io", "fr")
    said = lambda *x: pick(*x, word()) + pick("", ":", ",", " is", " no")
    us = lambda: pick(f"({d(3)}) {d(3)}-{d(4)}", f"({d(3)}){d(3)}-{d(4)}", f"{d(3)}-{d(3)}-{d(4)}", f"{d(3)}.{d(3)}.{d(4)}", f"{d(3)} {d(3)}-{d(4)}")
    phone = lambda: pick(us(), us(), us(), f"0{d(3)}{pick(' ', '/', '-')}{d(6)}")
    number_before = lambda: pick(d(int(rng.integers(1, 4))), d(int(rng.integers(1, 4))), f"{rng.integers(1900, 2030)}")
    ssn = lambda: f"{d(3)}-{d(2)}-{d(4)}"
    # what is marked with [[ and ]] is personal
    yes = (
        lambda: f"{said('mail', 'contact', 'write to', 'reach')} [[{word()}{pick(' (at) ', '(at)', ' [at] ', ' {at} ', ' at ')}{word()}{pick(' (dot) ', '(dot)', ' [dot] ', ' dot ')}{tld()}]]{pick(' ', '. ', ', ')}{word().title()}",
        lambda: f"{said('mail', 'contact', 'write to')} [[{word()}{pick('.' + word(), '')}{pick(' (at) ', '(at)', ' [at] ', '[at]', ' @ ')}{word()}.{tld()}]]{pick(' ', '. ', ', ')}{word().title()}",
        lambda: f"{said('phone', 'call', 'tel', 'mobile', 'fax')} [[{us()}]] {word()}",
        lambda: f"{said('tel', 'phone', 'mobile')}: [[0{d(3)}{pick(' ', '/', '-')}{d(6)}]] {word()}",
        lambda: f"{word()} {number_before()} [[{us()}]] {word()}",
        lambda: f"{said('phone', 'call')} " + pick(" ", " / ", ", ").join(f"[[{us()}]]" for _ in range(rng.integers(2, 4))) + f" {word()}",
        lambda: f"{said('ssn', 'social', 'SSN')} [[{ssn()}]] {word()}",
        lambda: f"{pick('ssn', word())} {pick('', number_before() + ' ')}[[{ssn()}]] {word()}",
        lambda: f"{word()} [[{number(True)}]] [[{number(True)}]] {word()}",
        lambda: f"{word()} {number(False)} [[{grouped(number(True))}]] {word()}",
        lambda: f"{word()} [[{grouped(number(True))}]] {number(False)} {word()}",
        lambda: f"{said('card', 'visa')} {d(int(rng.integers(4, 8)))} [[{grouped(number(True))}]] {word()}",
    )
    no = (
        lambda: f"{said('order', 'invoice', 'id')} {d(int(rng.integers(7, 13)))} {word()}",
        lambda: f"{said('order', 'invoice', 'id')} {number(False, int(rng.integers(13, 20)))} {word()}",
        lambda: f"{word()} {number(False)} {number(False)} {word()}",
        lambda: f"{word()} {rng.integers(1900, 2030)}{pick('-', '/', '.')}{rng.integers(1, 13):02d}{pick('-', '/', '.')}{rng.integers(1, 29):02d} {word()}",
        lambda: f"{word()} {rng.integers(1, 29)}{pick('/', '.')}{rng.integers(1, 13)}{pick('/', '.')}{rng.integers(1900, 2030)} {word()}",
        lambda: f"{word()} {rng.integers(1900, 2030)}-{rng.integers(1, 13):02d}-{rng.integers(1, 29):02d} {rng.integers(1, 24)} {word()}",
        lambda: f"{word()} {rng.integers(1900, 2030)}{pick('-', ' - ', '/', ' ')}{rng.integers(1900, 2030)} {word()}",
        lambda: f"version {rng.integers(0, 20)}.{rng.integers(0, 20)}.{d(int(rng.integers(3, 8)))} {word()}",
        lambda: f"{word()} at {word()}. {word().title()} {word()}",
        lambda: f"{word()} {word()} at {word()}.{word()} {word()}",
        lambda: f"{word()} at the {word()} dot {word()}",
        lambda: f"isbn {d(3)}-{d(1)}-{d(4)}-{d(4)}-{d(1)} {word()}",
        lambda: f"{word()} " + " ".join(d(3) for _ in range(rng.integers(3, 7))) + f" {word()}",
        lambda: f"{word()} " + " ".join(d(4) for _ in range(rng.integers(2, 9))) + f" {word()}",
        lambda: f"{word()} " + " ".join(d(int(rng.integers(1, 7))) for _ in range(rng.integers(3, 9))) + f" {word()}",
        lambda: f"{word()} {d(int(rng.integers(2, 5)))}.{d(2)} {d(int(rng.integers(2, 5)))}.{d(2)} {d(3)}.{d(2)} {word()}",
    )
    out = []
    for k in range(MADE):
        kinds = yes if k % 2 else no
        text, spans = kinds[k // 2 % len(kinds)](), []
        while "[[" in text:
            start, end = text.index("[["), text.index("]]") - 2
            text = text.replace("[[", "", 1).replace("]]", "", 1)
            spans.append((start, end))
        out.append((text, spans))
    return out


def train(docs: DataFrame, text_col: str = "text") -> Model:
    """Trains trees and thresholds on lines made by rule only, so the model is the same for every corpus: a candidate
    counts as personal if it is exactly one of its line's places. No row of docs is read, as none has such labels.

    Whole lines are held out for calibration and thresholds. A kind that no cut gives PRECISION keeps the highest
    probability held out as its threshold, with a warning."""
    names, lines = list(FEATURES), _made()
    made = docs.sparkSession.createDataFrame([(k, text) for k, (text, _) in enumerate(lines)], "line long, __text string")
    # not exploded: the filter of empty arrays would be pushed below every step, each inlined many times
    found = _candidates(_base(made, "__text"), "__text").select("line", "__found").collect()
    rows = sorted((r.line, c.start, c.end, *[float(c[n]) for n in names]) for r in found for c in r["__found"])
    x, line = np.array([r[3:] for r in rows], float), np.array([r[0] for r in rows])
    y = np.array([(r[1], r[2]) in lines[r[0]][1] for r in rows], float)
    held = (np.random.default_rng(1).random(len(lines)) < 0.25)[line]
    trees = boosting.fit(x[~held], y[~held])
    raw = trees.margin(x[held])
    w = logistic(np.stack((raw, np.ones(len(raw))), axis=1), y[held], np.ones(len(raw)))
    trees.scale, trees.shift = float(w[0]), float(w[1])
    p = trees.probability(x[held])
    limits = {}
    for kind, name in ADDED.items():
        own = x[held][:, 0] == kind
        cuts = [t for t in np.linspace(0.5, 0.99, 50) if (p[own] >= t).any() and y[held][own][p[own] >= t].mean() >= PRECISION]
        if not cuts:
            warnings.warn(f"no threshold gives spans of kind {name} a precision of {PRECISION}: the highest score held out is used")
        limits[kind] = float(min(cuts, default=p[own].max()))
    return Model(trees, limits)


def find(df: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """df with n_email, n_ip, n_card, n_phone (spans of the stated patterns), base_spans and spans: arrays of
    structs (no, kind, start, end) by kind and start, in characters of the text, ends exclusive.

    spans holds all base spans, and those candidates apart from them that the trees accept, of overlapping ones the
    likeliest, of equally likely ones the longest, then the first: addresses in disguise (email), card and social
    security numbers (card, ssn) and other runs of digits (phone). Spans of different stated kinds may overlap each
    other; added ones overlap none. A null text counts as empty. Very long texts are searched whole; equal rows have
    equal results; an empty table gives an empty one. Columns of df that have these names are replaced."""
    made = ["n_email", "n_ip", "n_card", "n_phone", "base_spans", "spans"]
    kept = [F.col(f"__row.`{c}`").alias(c) for c in df.columns if c.lower() not in made]
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("__row"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("__text"))
    found = _candidates(_base(rows, "__text"), "__text")
    p = model.trees.sql([f"x.{n}" for n in FEATURES])
    limit = "case x.no " + " ".join(f"when {k} then {t!r}D" for k, t in model.thresholds.items()) + " end"
    found = found.withColumn("__scored", F.expr(f"transform(__found, x -> named_struct('rank', -{p}, 'shorter', x.start - x.end, 'start', x.start, 'end', x.end, 'no', x.kind))"))
    found = found.withColumn("__likely", F.expr(f"array_sort(filter(__scored, x -> -x.rank >= {limit}), (a, b) -> case when a.start <> b.start then a.start - b.start else a.end - b.end end)"))
    names = "case x.no " + " ".join(f"when {k} then '{n}'" for k, n in ADDED.items()) + " end"
    found = found.withColumn("__more", F.expr(f"transform({_best('__likely')}, x -> named_struct('no', x.no, 'kind', {names}, 'start', x.start, 'end', x.end))"))
    return found.select(*kept, *[F.size(f"__{k}").cast("long").alias(f"n_{k}") for k in KINDS], F.col("__base").alias("base_spans"), F.array_sort(F.concat("__base", "__more")).alias("spans"))


def redact(df: DataFrame, model: Model, text_col: str = "text", mark: str = "[PII]") -> DataFrame:
    """df with its texts' spans replaced by mark; null stays null."""
    found = find(df, model, text_col).withColumn("__by_start", F.expr("array_sort(transform(spans, x -> named_struct('start', x.start, 'end', x.end)))"))
    text = F.when(F.col(f"`{text_col}`").isNotNull(), cut_out(f"`{text_col}`", "__by_start", mark))
    return found.withColumn(text_col, text).select(*[f"`{c}`" for c in df.columns])

