"""Secrets in texts: base patterns, and runs of characters that a battery of tests finds random.

Everything is DataFrame functions: matches are marked in the text with private characters, whose
places give those of the matches.
"""

from __future__ import annotations

from functools import reduce
from math import exp

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loglark.llm.common import LOWER, UPPER, stage

# The base patterns, the least length of what they take, and the order of kinds.
KINDS = ("assign", "access", "hex", "random")
RANDOM = 3
ASSIGN = (
    "((?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]"
    r"|[aA][pP][iI]_?[kK][eE][yY])[\"']?\x20*[:=]\x20*[\"']?)([A-Za-z0-9+/_.=-]+)"
)
#: Least lengths: of group 2, of a whole access key, of a whole hex run. Within a match of the last
#: two every shorter one ends at the same place, so their patterns can hold the length; the first is
#: dropped after the scan.
ASSIGNED = 8
ACCESS = "AKIA[A-Z0-9]{12,}"
HEX = "[0-9a-f]{32,}"

#: Runs of at least so many characters of the wide alphabet are tested.
LEAST = 20
CANDIDATE = rf"[A-Za-z0-9+/_=-]{{{LEAST},}}"
_DIGITS = "0123456789"
#: Private characters, which no pattern takes, mark places; a text's own become commas first, which no pattern takes either.
_MARKS = "\uE000\uE001\uE002"
#: Encodings, the narrowest first: name, all its symbols in order, and a pattern of the whole run.
ENCODINGS = (
    ("decimal", _DIGITS, "^[0-9]+$"),
    ("hex", _DIGITS + "abcdef", "^[0-9a-f]+$"),
    ("hex", _DIGITS + "ABCDEF", "^[0-9A-F]+$"),
    ("letters", LOWER, "^[a-z]+$"),
    ("letters", UPPER, "^[A-Z]+$"),
    ("base32", UPPER + "234567", "^[A-Z2-7]+$"),
    ("base36", _DIGITS + LOWER, "^[0-9a-z]+$"),
    ("base36", _DIGITS + UPPER, "^[0-9A-Z]+$"),
    ("base62", UPPER + LOWER + _DIGITS, "^[A-Za-z0-9]+$"),
    ("base64", UPPER + LOWER + _DIGITS + "+/", "^[A-Za-z0-9+/]+$"),
    ("base64url", UPPER + LOWER + _DIGITS + "-_", "^[A-Za-z0-9_-]+$"),
)

#: A test refuses randomness beyond this normal score: three two-sided tests at 0.001 together.
REFUSED = 3.587
#: Written language: sums of the squares and cubes of letter frequencies, and the most often that
#: names joined of words go from letter to digit, digit to letter or small to capital letter.
SQUARES, CUBES, CHANGES = 0.0655, 0.0053, 0.15
#: Expected share of written runs among those reported, in each class of encoding and length.
FALSE_SHARE = 0.01
#: Probabilities are counted in steps of a factor exp(1 / STEPS), down to exp(-DEEPEST).
STEPS, DEEPEST = 8, 200


def _without_marks(text: Column) -> Column:
    return F.translate(text, _MARKS, ",,,")


def _marked_places(text: Column, pattern: str, marked: str) -> Column:
    """(start, middle, end) of all matches, leftmost first and without overlap, in code points.

    ``marked`` puts three marks into each match. A mark's place, less the marks before it, is
    the place in the text; one pass over the characters, however many matches there are.
    """
    letters = F.split(F.regexp_replace(_without_marks(text), pattern, marked), "")

    def places(mark: str) -> Column:
        return F.filter(F.transform(letters, lambda c, i: F.when(c == mark, i)), lambda i: i.isNotNull())

    at = [places(m) for m in _MARKS]
    both = F.arrays_zip(*[a.alias(n) for a, n in zip(at, ("start", "middle", "end"), strict=True)])
    return F.transform(
        both,
        lambda x, i: F.struct(
            *[(x[n] - 3 * i - k).cast("int").alias(n) for k, n in enumerate(("start", "middle", "end"))]
        ),
    )


def _span(start: Column, kind: int, end: Column) -> Column:
    return F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"))


def _no_spans() -> Column:
    return F.array().cast("array<struct<start:int,kind:int,end:int>>")


def base_spans(text: Column, kind: int) -> Column:
    """Spans of one base kind."""
    begin, middle, end = _MARKS
    if kind == 0:
        pattern, found = ASSIGN, _marked_places(text, ASSIGN, f"{begin}$1{middle}$2{end}")
        found = F.filter(found, lambda x: x["end"] - x["middle"] >= ASSIGNED)
    else:
        pattern = (ACCESS, HEX)[kind - 1]
        found = _marked_places(text, pattern, f"{begin}$0{middle}{end}")
    spans = F.transform(found, lambda x: _span(x["start"], kind, x["end"]))
    return F.when(text.rlike(pattern), spans).otherwise(_no_spans())


def _squares(run: Column, symbols: str) -> Column:
    """Sum over the symbols of the square of how often each comes."""
    n = F.length(run)
    each = F.array(*[F.lit(s) for s in symbols])
    return F.aggregate(each, F.lit(0.0), lambda acc, s: acc + F.pow(n - F.length(F.replace(run, s, F.lit(""))), F.lit(2)))


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)


def _battery(run: Column, symbols: str) -> list[Column]:
    """Normal scores of the run under "all symbols are equally likely and independent":
    chi-squared uniformity, runs above and below the middle, serial correlation."""
    k, n = len(symbols), F.length(run).cast("double")
    chi = k / n * _squares(run, symbols) - n
    cube = F.pow(chi / (k - 1), F.lit(1 / 3))
    uniform = (cube - (1 - 2 / (9 * (k - 1)))) / F.lit((2 / (9 * (k - 1))) ** 0.5)

    halves = F.translate(run, symbols, "l" * (k // 2) + "h" * (k - k // 2))
    changed = (n - F.length(F.regexp_replace(halves, "l(?=h)|h(?=l)", ""))).cast("double")
    high = (k - k // 2) / k
    likely = 2 * high * (1 - high)
    # Neighbouring changes are independent where both halves are of one size, as in all but odd alphabets.
    runs = (changed - (n - 1) * likely) / F.sqrt((n - 1) * likely * (1 - likely))

    values = F.transform(F.split(run, ""), lambda c: F.instr(F.lit(symbols), c).cast("double") - (k + 1) / 2)
    follow = F.zip_with(F.slice(values, F.lit(1), F.size(values) - 1), F.slice(values, F.lit(2), F.size(values) - 1), lambda a, b: a * b)
    variance = (k * k - 1) / 12
    serial = _sum(follow) / (F.sqrt(n - 1) * variance)
    return [uniform, runs, serial]


def _written(run: Column) -> Column:
    """How likely written language is at least as even and as changeable: the bounds of two tests, combined.

    The first takes the sum of squared letter counts, which written language makes larger by
    so much more, compared with its spread, the longer a run is; the second the changes of
    kind between neighbours. Both go down with length, so a short run is never told apart.
    """
    n = F.length(run).cast("double")
    mean = n + n * (n - 1) * SQUARES
    spread = 4 * n * (n - 1) * (n - 2) * (CUBES - SQUARES**2) + 2 * n * (n - 1) * (SQUARES - SQUARES**2)
    even = (mean - _squares(F.lower(run), LOWER + _DIGITS + "+/_-")) / F.sqrt(spread)
    log_even = F.when(even > 0, -even * even / 2).otherwise(0.0)

    plain = F.regexp_replace(run, "[^A-Za-z0-9]", "")
    m = F.greatest(F.length(plain) - 1, F.lit(1)).cast("double")
    changes = F.length(plain) - F.length(
        F.regexp_replace(plain, "[a-z](?=[A-Z0-9])|[A-Z](?=[0-9])|[0-9](?=[A-Za-z])", "")
    )
    rate = changes / m
    gap = rate * F.log(F.greatest(rate, F.lit(1e-9)) / CHANGES) + (1 - rate) * F.log(F.greatest(1 - rate, F.lit(1e-9)) / (1 - CHANGES))
    log_changes = F.when(rate > CHANGES, -m * gap).otherwise(0.0)
    both = log_even + log_changes
    return both + F.log(1 - both)


def _class(encoding: str, run: Column) -> Column:
    """Encoding and length to a power of two: the class in which false reports are controlled."""
    return F.concat(F.lit(encoding + ":"), F.floor(F.log2(F.length(run).cast("double"))).cast("string"))


def candidates(text: Column, base: Column) -> Column:
    """Runs that touch no base span and that the battery does not refuse: start, end, class, step.

    ``step`` counts how unlikely written language makes the run. Padding at its end belongs to
    the span and to no test. Digits alone are numbers and are left out.
    """
    begin, middle, end = _MARKS
    places = F.arrays_zip(
        _marked_places(text, CANDIDATE, f"{begin}$0{middle}{end}").alias("at"),
        F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0)).alias("run"),
    )
    # A key or a hex run lies in one run whole; an assignment can reach over several.
    assigned = F.filter(base, lambda s: s["kind"] == 0)
    apart = F.filter(
        F.filter(places, lambda x: ~x["run"].rlike(f"{ACCESS}|{HEX}")),
        lambda x: ~F.exists(assigned, lambda s: (x["at"]["start"] < s["end"]) & (s["start"] < x["at"]["end"])),
    )
    runs = F.transform(
        apart,
        lambda x: F.struct(x["at"]["start"].alias("start"), x["at"]["end"].alias("end"), F.regexp_replace(x["run"], "=+$", "").alias("run")),
    )
    runs = F.filter(runs, lambda x: F.length(x["run"]) >= LEAST)

    def tested(x: Column) -> Column:
        step = F.least(F.floor(-_written(x["run"]) * STEPS), F.lit(DEEPEST * STEPS)).cast("int")
        out = F.lit(None).cast("struct<start:int,end:int,class:string,step:int>")
        for name, symbols, pattern in reversed(ENCODINGS):
            if name == "decimal":
                verdict = F.lit(False)
            else:
                verdict = reduce(lambda a, b: a & b, [F.abs(z) <= REFUSED for z in _battery(x["run"], symbols)])
            one = F.struct(x["start"].alias("start"), x["end"].alias("end"), _class(name, x["run"]).alias("class"), step.alias("step"))
            out = F.when(x["run"].rlike(pattern), F.when(verdict, one)).otherwise(out)
        return out

    kept = F.filter(F.transform(runs, tested), lambda x: x.isNotNull())
    none = F.array().cast("array<struct<start:int,end:int,class:string,step:int>>")
    return F.when(text.rlike(CANDIDATE), kept).otherwise(none)


def least_steps(found: DataFrame, false_share: float = FALSE_SHARE) -> dict[str, int]:
    """By class the least step that is reported: Benjamini and Hochberg's rule over counts by step.

    ``found`` has a row per tested run with its class and step. Counts are at most one row for
    each of the (bounded) classes and steps, whatever the corpus.
    """
    counts = found.groupBy("class", "step").agg(F.count("*").alias("n")).collect()
    by: dict[str, dict[int, int]] = {}
    for row in counts:
        by.setdefault(row["class"], {})[row["step"]] = row["n"]
    out = {}
    for name, steps in by.items():
        total, seen = sum(steps.values()), 0
        for step in sorted(steps, reverse=True):
            seen += steps[step]
            if exp(-step / STEPS) * total <= false_share * seen:
                out[name] = step
    return out


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    ordered = F.array_sort(spans)
    return F.array_join(F.transform(ordered, lambda s: F.concat_ws(":", names[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))), ",")


def secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", false_share: float = FALSE_SHARE) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_assign, n_access, n_hex (base spans), base_sha256, spans, n_random.

    Base spans come from the patterns. Every other run of 20 and more characters of an encoding
    is tested for randomness in that encoding's alphabet: chi-squared uniformity, runs about the
    middle, serial correlation. What no test refuses is reported as ``random`` if written language
    is unlikely to give it, with the share of false reports controlled in each class of encoding
    and length over the whole corpus; so a short run needs more than a long one.

    Offsets are code points, ends exclusive. A null text is empty; an empty list of spans is the
    empty string. Null or repeated ids and repeated rows are rows like others; a text of any
    length is read whole. An empty table gives an empty result. Only the id and the text are
    read, whatever other columns are called.
    """
    text = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    base = text.withColumn("_base", F.concat(*[base_spans(F.col("_text"), k) for k in range(RANDOM)]))
    tested = stage(
        base.select("doc_id", "_base", candidates(F.col("_text"), F.col("_base")).alias("_found")), "secret-runs"
    )
    least = least_steps(tested.select(F.explode("_found").alias("f")).select("f.class", "f.step"), false_share)
    more = _no_spans()
    if least:
        limits = F.create_map(*[F.lit(x) for pair in sorted(least.items()) for x in pair])
        chosen = F.filter("_found", lambda x: x["step"] >= F.coalesce(F.try_element_at(limits, x["class"]), F.lit(2**31 - 1)))
        more = F.transform(chosen, lambda x: _span(x["start"], RANDOM, x["end"]))

    def count(kind: int) -> Column:
        return F.size(F.filter("_base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{KINDS[kind]}")

    return tested.select(
        "doc_id",
        *[count(k) for k in range(RANDOM)],
        F.sha2(_joined(F.col("_base")).cast("binary"), 256).alias("base_sha256"),
        _joined(F.concat("_base", more)).alias("spans"),
        F.size(more).cast("long").alias("n_random"),
    )


def _sql_places(name: str, pattern: str) -> str:
    """Start and text of every match of ``pattern`` in table t (row, text), as a query."""
    p = pattern.replace("'", "''")
    return f"""
        {name} as (
          select row, start, m from (
            select row, m, sum(length(g)) over w + coalesce(sum(length(m)) over (partition by row order by i rows between unbounded preceding and 1 preceding), 0) as start
            from (select row, unnest(regexp_extract_all(text, '{p}')) as m, unnest(regexp_split_to_array(text, '{p}')) as g,
                         generate_subscripts(regexp_split_to_array(text, '{p}'), 1) as i from t)
            window w as (partition by row order by i)) where m is not null)"""


def _sql() -> str:
    encodings = ", ".join(f"({i}, '{n}', '{s}', '{p}')" for i, (n, s, p) in enumerate(ENCODINGS))
    folded = LOWER + _DIGITS + "+/_-"
    k, x = "length(symbols)", "run"
    squares = "list_sum(list_transform(string_split({a}, ''), lambda s: pow(n - length(replace({x}, s, '')), 2)))"
    chi = f"({k} / n * {squares.format(a='symbols', x=x)} - n)"
    df = f"({k} - 1)"
    half = f"(instr(symbols, {x}[i]) > {k} // 2)"
    other = f"(instr(symbols, {x}[i + 1]) > {k} // 2)"
    high = f"(({k} - {k} // 2) / {k})"
    pair = f"{x}[i] || {x}[i + 1]"
    spread = f"(4 * n * (n - 1) * (n - 2) * {CUBES - SQUARES**2!r} + 2 * n * (n - 1) * {SQUARES - SQUARES**2!r})"
    pairs = "^([a-z][A-Z0-9]|[A-Z][0-9]|[0-9][A-Za-z])$"
    assign = ASSIGN.replace("'", "''")
    return f"""
        with t as (select row_number() over () as row, doc_id, coalesce(text, '') as text from documents),
        {_sql_places("pa", ASSIGN)}, {_sql_places("pk", ACCESS)}, {_sql_places("ph", HEX)}, {_sql_places("pc", CANDIDATE)},
        base as (
          select row, start, 0 as kind, start + length(m) as stop from pa where length(regexp_extract(m, '{assign}', 2)) >= {ASSIGNED}
          union all select row, start, 1, start + length(m) from pk union all select row, start, 2, start + length(m) from ph),
        e as (select * from (values {encodings}) as v(pos, name, symbols, pattern)),
        runs as (
          select row, start, start + length(m) as stop, regexp_replace(m, '=+$', '') as run, length(regexp_replace(m, '=+$', ''))::double as n
          from pc where not exists (from base b where b.row = pc.row and b.start < pc.start + length(pc.m) and pc.start < b.stop)),
        coded as (
          select runs.*, arg_min(e.name, e.pos) as name, arg_min(e.symbols, e.pos) as symbols
          from runs join e on regexp_matches(run, e.pattern) where n >= {LEAST} group by all),
        tested as (
          select *, (pow({chi} / {df}, 1 / 3) - (1 - 2 / (9 * {df}))) / sqrt(2 / (9 * {df})) as z1,
            (list_sum(list_transform(range(1, n::bigint), lambda i: ({half} <> {other})::int)) - (n - 1) * 2 * {high} * (1 - {high}))
              / sqrt((n - 1) * 2 * {high} * (1 - {high}) * (1 - 2 * {high} * (1 - {high}))) as z2,
            list_sum(list_transform(range(1, n::bigint), lambda i: (instr(symbols, {x}[i]) - ({k} + 1) / 2) * (instr(symbols, {x}[i + 1]) - ({k} + 1) / 2)))
              / (sqrt(n - 1) * (pow({k}, 2) - 1) / 12) as z3,
            (n + n * (n - 1) * {SQUARES!r} - {squares.format(a=f"'{folded}'", x=f"lower({x})")}) / sqrt({spread}) as even,
            regexp_replace(run, '[^A-Za-z0-9]', '', 'g') as plain
          from coded where name <> 'decimal'),
        changed as (
          select *, greatest(length(plain) - 1, 1)::double as m,
            coalesce(list_sum(list_transform(range(1, length(plain)), lambda i: regexp_matches(plain[i] || plain[i + 1], '{pairs}')::int)), 0) / greatest(length(plain) - 1, 1) as rate
          from tested where abs(z1) <= {REFUSED} and abs(z2) <= {REFUSED} and abs(z3) <= {REFUSED}),
        likely as (
          select *, case when even > 0 then -even * even / 2 else 0 end
            + case when rate > {CHANGES} then -m * (rate * ln(greatest(rate, 1e-9) / {CHANGES}) + (1 - rate) * ln(greatest(1 - rate, 1e-9) / {1 - CHANGES!r})) else 0 end as bound
          from changed),
        stepped as (
          select row, start, stop, name || ':' || floor(log2(n))::bigint as class, least(floor(-(bound + ln(1 - bound)) * {STEPS}), {DEEPEST * STEPS})::bigint as step from likely),
        ranked as (
          select class, step, count(*) over (partition by class) as total, count(*) over (partition by class order by step desc) as seen from stepped),
        least_steps as (select class, min(step) as least from ranked where exp(-step / {STEPS}) * total <= {FALSE_SHARE} * seen group by 1),
        spans as (
          from base union all select row, start, {RANDOM}, stop from stepped join least_steps using (class) where step >= least),
        named as (select *, {list(KINDS)!r}[kind + 1] || ':' || start || ':' || stop as s from spans),
        found as (
          select row, count(*) filter (kind = 0) as n_assign, count(*) filter (kind = 1) as n_access, count(*) filter (kind = 2) as n_hex,
            string_agg(s, ',' order by start, kind) filter (kind < {RANDOM}) as base, string_agg(s, ',' order by start, kind) as spans,
            count(*) filter (kind = {RANDOM}) as n_random
          from named group by 1)
        select doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex,
          sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans, coalesce(n_random, 0) as n_random
        from t left join found using (row)"""


SQL = _sql()
