"""Secret scans with DataFrame functions only.

Base kinds are leftmost non-overlapping matches of fixed patterns
(``assign``, ``access``, ``hex``).  Two further kinds come from entropy:
candidate strings are maximal runs of a character class that hold every
required sort of character, and a window of ``WINDOW`` characters slides
over each.  The window's Shannon entropy is kept by incremental counts: a
step adds the entering character's count, takes off the leaving one's, and
updates ``sum(c * log2(c))`` from a table, in integers, so that equal
windows give equal results anywhere.  A candidate whose best window reaches
the class's threshold is a span, unless the allow-list suppresses it (known
examples and digests of nothing, counting-up sequences).  The allow-list
suppresses a candidate only if no whole window lies beside what it names.
Candidates of the mixed class that consist of small letters in runs of three
or more to nearly a half (paths, identifiers, version strings) are no secrets.

All work is local to a row: no shuffle, no Python, and no step is quadratic
in the text.  Positions are code points, ends exclusive.

Defined results: a null text is empty and has no spans; repeated rows are
scanned alike; extra columns are ignored.
"""

from __future__ import annotations

from math import log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW = 20
BLOCK = 64
PLACEHOLDER = "[SECRET]"

# The patterns of the base kinds.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
BASE_KINDS = ("assign", "access", "hex")

# Strings that are no secrets.
_KNOWN = "|".join((
    "example", "0123456789", "1234567890", "abcdefghij", "deadbeefdeadbeef",
    "wJalrXUtnFEMI/K7MDENG/bPxRfiCYEXAMPLEKEY",
    "d41d8cd98f00b204e9800998ecf8427e",
    "da39a3ee5e6b4b0d3255bfef95601890afd80709",
    "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855",
))
_BESIDE = f".{{0,{WINDOW - 1}}}"  # less than a window
#: up to eight known strings; the bound keeps backtracking small
ALLOWED = (f"^{_BESIDE}(?:{_KNOWN})(?:{_BESIDE}(?:{_KNOWN})){{0,7}}{_BESIDE}$",)

#: kind: (class, required sorts of characters, alphabet in lookup order, fold case, threshold in bits).
#: A random window stays below its class's threshold in one of 1,000 draws at most (base32 for the upper-case class).
ENTROPY_KINDS = {
    "entropy_hex": ("0-9A-Fa-f", ("0-9", "A-Fa-f"), "0123456789abcdef", True, 2.7),
    "entropy_mixed": ("A-Za-z0-9+/_=-", ("0-9", "a-z", "A-Z"),
                      "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-", False, 3.48),
    "entropy_lower": ("0-9a-z", ("0-9", "a-z"), "0123456789abcdefghijklmnopqrstuvwxyz", False, 3.24),
    "entropy_upper": ("0-9A-Z", ("0-9", "A-Z"), "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ", False, 3.14),
}
#: Classes whose candidates may be made of words: from 40 % of the length and three and a half more letters in runs
#: of three or more on they are; one in 300 random base64 strings of 20 is, fewer of longer ones.
WORDLIKE = ("entropy_mixed",)
SCALE = 1_000_000
#: ``c * log2(c)`` in millionths, for counts of 0 to WINDOW.
TABLE = [round(SCALE * c * log2(c)) if c else 0 for c in range(WINDOW + 1)]


def most_concentration(bits: float) -> int:
    """Windows of at least ``bits`` entropy have ``sum(c * log2(c))`` of at most this."""
    return int(SCALE * WINDOW * (log2(WINDOW) - bits))


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once, also inside lambdas."""
    return F.transform(F.array(value), body)[0]


def _starts(lengths: Column) -> Column:
    """Sums of all elements before each: block sums first, so that no element
    adds up more than a block and the sums of the blocks before it."""
    n = F.size(lengths)
    total = lambda part: F.aggregate(part, F.lit(0), lambda a, x: a + x)

    def with_blocks(blocks):
        def with_bases(bases):
            return F.transform(lengths, lambda _, i: bases[F.floor(i / BLOCK).cast("int")] + total(
                F.slice(lengths, F.floor(i / BLOCK).cast("int") * BLOCK + 1, i % BLOCK)))
        return _let(F.transform(blocks, lambda _, b: total(F.slice(blocks, F.lit(1), b))), with_bases)

    numbers = F.sequence(F.lit(0), F.floor((n - 1) / BLOCK).cast("int"))
    blocks = F.transform(numbers, lambda b: total(F.slice(lengths, b * BLOCK + 1, F.lit(BLOCK))))
    return F.when(n == 0, F.array().cast("array<int>")).otherwise(_let(blocks, with_blocks))


def _matches(text: Column, pattern: str, group: int = 0) -> Column:
    """``array<struct<start, end, value>>`` of the pattern's matches."""
    found = F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"), F.split(text, pattern, -1).alias("g"))

    def placed(s):
        lengths = F.zip_with(s["m"], F.slice(s["g"], F.lit(1), F.size(s["m"])), lambda m, g: F.length(m) + F.length(g))
        return _let(lengths, lambda ls: F.transform(
            F.arrays_zip(s["m"].alias("m"), F.slice(s["g"], F.lit(1), F.size(s["m"])).alias("g"), _starts(ls).alias("p")),
            lambda x: F.struct((x["p"] + F.length(x["g"])).alias("start"),
                               (x["p"] + F.length(x["g"]) + F.length(x["m"])).alias("end"),
                               (x["m"] if group == 0 else F.regexp_extract(x["m"], pattern, group)).alias("value"))))

    empty = F.array().cast("array<struct<start:int,end:int,value:string>>")
    return _let(found, lambda s: F.when(F.size(s["m"]) == 0, empty).otherwise(placed(s)))


def _concentration(candidate: Column, alphabet: str, fold: bool) -> Column:
    """Smallest ``sum(c * log2(c))`` of any window of the candidate, by incremental counts."""
    table = F.array(*[F.lit(x) for x in TABLE])
    chars = F.split(F.lower(candidate) if fold else candidate, "")
    codes = F.transform(chars, lambda c: F.position(c, F.lit(alphabet)) - 1)

    def slide(codes):
        zero = F.struct(F.array_repeat(F.lit(0), len(alphabet)).alias("counts"), F.lit(0).alias("sum"),
                        F.lit(2**31 - 1).alias("best"), F.lit(0).alias("i"))

        def step(s, code):
            leaving = F.when(s["i"] >= WINDOW, codes[s["i"] - WINDOW]).otherwise(F.lit(-1))
            return _let(F.struct(leaving.alias("out"), s["counts"][code].alias("c")), lambda v: _let(
                F.struct(F.transform(s["counts"], lambda n, j: n + F.when(j == code, 1).otherwise(0)
                                     - F.when(j == v["out"], 1).otherwise(0)).alias("counts"),
                         # the leaving character's count, after the entering one is in
                         F.when(v["out"] >= 0, s["counts"][F.greatest(v["out"], F.lit(0))]
                                + F.when(v["out"] == code, 1).otherwise(0)).otherwise(F.lit(0)).alias("d"),
                         (s["sum"] + table[v["c"] + 1] - table[v["c"]]).alias("sum")),
                lambda u: _let(
                    (u["sum"] - F.when(u["d"] > 0, table[u["d"]] - table[F.greatest(u["d"] - 1, F.lit(0))]).otherwise(0)),
                    lambda total: F.struct(
                        u["counts"].alias("counts"), total.alias("sum"),
                        F.when(s["i"] >= WINDOW - 1, F.least(s["best"], total)).otherwise(s["best"]).alias("best"),
                        (s["i"] + 1).alias("i")))))

        return F.aggregate(codes, zero, step, lambda s: s["best"])

    return _let(codes, slide)


def entropy_spans(text: Column, kind: str) -> Column:
    """Spans of one entropy kind: ``array<struct<start, end, value>>``."""
    members, required, alphabet, fold, bits = ENTROPY_KINDS[kind]
    ahead = "".join(f"(?=[{members}]*[{x}])" for x in required)
    pattern = f"(?<![{members}]){ahead}[{members}]{{{WINDOW},}}"
    allowed = "(?i)" + "|".join(ALLOWED)

    def no_words(value):
        if kind not in WORDLIKE:
            return F.lit(True)
        return 200 * (F.length(value) - F.length(F.regexp_replace(value, "[a-z]{3,}", ""))) < 80 * F.length(value) + 700

    return F.filter(_matches(text, pattern), lambda x: ~x["value"].rlike(allowed) & no_words(x["value"]) & (
        _concentration(x["value"], alphabet, fold) <= most_concentration(bits)))


def spans(text: Column) -> Column:
    """All spans: ``array<struct<start, rank, end, kind>>`` by start, then kind as listed."""
    text = F.coalesce(text, F.lit(""))
    found = {
        "assign": F.filter(_matches(text, ASSIGN, 1), lambda x: F.length(x["value"]) >= 6),
        "access": F.filter(_matches(text, ACCESS), lambda x: x["end"] - x["start"] >= 20),
        # a run of the class matches from its first character on, so the length can be asked for at once
        "hex": _matches(text, HEX[:-1] + "{24,}"),
    } | {kind: entropy_spans(text, kind) for kind in ENTROPY_KINDS}

    def named(rank, kind, matches):
        return F.transform(matches, lambda x: F.struct(x["start"].alias("start"), F.lit(rank).alias("rank"),
                                                       x["end"].alias("end"), F.lit(kind).alias("kind")))

    return F.sort_array(F.concat(*[named(rank, kind, v) for rank, (kind, v) in enumerate(found.items())]))


def spans_text(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"),
                                                                 x["end"].cast("string"))), ",")


def _merged(found: Column) -> Column:
    """Overlapping spans of a sorted array joined."""
    def add(acc, x):
        last = F.element_at(acc, -1)
        inside = (F.size(acc) > 0) & (F.try_element_at(acc, F.lit(-1))["end"] >= x["start"])
        return F.when(inside, F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(F.struct(
            last["start"].alias("start"), F.greatest(last["end"], x["end"]).alias("end"))))).otherwise(
            F.concat(acc, F.array(F.struct(x["start"].alias("start"), x["end"].alias("end")))))
    return F.aggregate(found, F.array().cast("array<struct<start:int,end:int>>"), add)


def redact(docs: DataFrame, text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """``docs`` with its columns, every span replaced by ``PLACEHOLDER``; texts without spans stay."""
    text = F.col(f"`{text_col}`")

    def clean(found):
        cut = _merged(found)
        return _let(cut, lambda c: F.array_join(F.zip_with(
            F.concat(F.array(F.lit(0)), F.transform(c, lambda s: s["end"])),
            F.concat(F.transform(c, lambda s: s["start"]), F.array(F.length(text))),
            lambda a, b: F.substring(text, a + 1, b - a)), PLACEHOLDER))

    new = _let(spans(text), lambda found: F.when(F.size(found) == 0, text).otherwise(clean(found)))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    held = docs.select(row.alias("row"), new.alias("clean"))
    out = []
    for c in docs.columns:
        if c == text_col:
            out.append(F.col("clean").alias(c))
        elif c == length_col:
            changed = F.col("clean") != F.col("row")[text_col]
            out.append(F.when(changed, F.length("clean").cast(docs.schema[c].dataType)).otherwise(F.col("row")[c]).alias(c))
        else:
            out.append(F.col("row")[c].alias(c))
    return held.select(*out)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans`` per row."""
    found = docs.select(F.col(f"`{id_col}`").alias("doc_id"), spans(F.col(f"`{text_col}`")).alias("found"))

    def count(kind):
        return F.size(F.filter("found", lambda x: x["kind"] == kind)).cast("long")

    base = F.filter("found", lambda x: x["kind"].isin(*BASE_KINDS))
    return found.select("doc_id", *[count(k).alias(f"n_{k}") for k in BASE_KINDS],
                        F.sha2(spans_text(base).cast("binary"), 256).alias("base_sha256"),
                        spans_text(F.col("found")).alias("spans"))


def op1_secrets(spark, sf_dir: str) -> DataFrame:
    from vecspark.llm.common import table

    return scan(table(spark, sf_dir, "documents"))


def _sql() -> str:
    kinds = [("assign", ASSIGN.replace("'", "''"), "length(regexp_extract(m, '{re}', 1)) >= 6"),
             ("access", ACCESS, "length(m) >= 20"), ("hex", HEX, "length(m) >= 24")]
    for kind, (members, required, _, fold, bits) in ENTROPY_KINDS.items():
        allowed = "|".join(ALLOWED)
        char = "lower(m[i])" if fold else "m[i]"
        has = " AND ".join(f"regexp_matches(m, '[{x}]')" for x in required)
        words = "200 * (length(m) - length(regexp_replace(m, '[a-z]{3,}', '', 'g'))) < 80 * length(m) + 700" if kind in WORDLIKE else "TRUE"
        low = (f"(SELECT min(z) FROM (SELECT s, sum(round({SCALE} * c * log2(c))) AS z FROM (SELECT s, c1, count(*) AS c FROM "
               f"(SELECT s, {char} AS c1 FROM unnest(range(1, length(m) - {WINDOW} + 2)) AS a(s), "
               f"unnest(range(s, s + {WINDOW})) AS b(i)) GROUP BY s, c1) GROUP BY s)) <= {most_concentration(bits)}")
        kinds.append((kind, f"[{members}]{{{WINDOW},}}", f"{has} AND NOT regexp_matches(m, '(?i){allowed}') AND {words} AND {low}"))
    parts = []
    for rank, (kind, pattern, test) in enumerate(kinds):
        test = test.replace("{re}", pattern)
        parts.append(f"""
  SELECT doc_id, {rank} AS rank, '{kind}' AS kind, p + length(g) AS s, p + length(g) + length(m) AS e FROM (
    SELECT *, coalesce(sum(length(g) + length(m)) OVER (PARTITION BY doc_id ORDER BY i
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS p
    FROM (SELECT doc_id, unnest(ms) AS m, unnest(gs[:len(ms)]) AS g, unnest(range(len(ms))) AS i
      FROM (SELECT doc_id, regexp_extract_all(t, '{pattern}') AS ms, string_split_regex(t, '{pattern}') AS gs FROM d)))
  WHERE {test}""")
    return f"""
WITH d AS MATERIALIZED (SELECT doc_id, coalesce(text, '') AS t FROM documents),
f AS MATERIALIZED ({" UNION ALL ".join(parts)}),
s AS (SELECT doc_id, count(*) FILTER (rank = 0) AS n_assign, count(*) FILTER (rank = 1) AS n_access,
  count(*) FILTER (rank = 2) AS n_hex,
  string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank, e) FILTER (rank < 3) AS base,
  string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank, e) AS spans FROM f GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN s USING (doc_id)"""


OP1_SQL = _sql()
