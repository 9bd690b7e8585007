"""Secret scan with a randomness test battery, all in DataFrame functions.

Base spans are plain patterns: assignments to secret names, access keys, long hex runs.
The battery looks at further tokens of ``MIN_TOKEN`` characters or more.  Each has an
inferred encoding (the smallest alphabet that holds it) and three tests of being random
in it: chi-squared of its character counts against uniformity, the number of runs above
and below the middle of the alphabet, and the serial correlation of neighbours.  The
smallest of the three p-values, Bonferroni-corrected, is its randomness p.

False-discovery control knows the token's length.  A random token changes between small
letters, capitals and digits about every other character; words, identifiers and paths
do so only where a word ends.  Tokens with a change at most every ``WORD_LENGTH``
characters are decoys; others that mix letters with digits or case are targets.  Per
power-of-two length class, the accepted p is the smallest bin for which the decoys at or
above it, and one more, are at most ``FALSE_SHARE`` of the targets.  Where there are too
few targets for that, nothing is added; short tokens, on which the tests have little
power, need larger p than long ones.

Scale.  One scan counts (length class, p bin) pairs with partial aggregation; the few
hundred counts give a threshold per class, which enters the second scan as a literal.
Texts are never shuffled.  Cheap pattern filters skip texts without candidates.  Which
tokens touch a base span is read off copies of the text in which those spans are marked,
so no token is held against all spans of its text.

Cases.  A null text counts as empty and has no spans.  Spans of the battery that overlap
a base span are not added.  Repeated rows are scanned row by row."""

from __future__ import annotations

import math
import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh

# Base patterns, in the order in which kinds are listed.
_NAME = r"(?i:password|passwd|secret|token|api_?key)"
ASSIGN = _NAME + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{32,}"  # maximal runs, so the same as dropping shorter ones
KINDS = ("assign", "access", "hex", "random")
MIN_VALUE, MIN_ACCESS = 8, 16

MIN_TOKEN = 16
TOKEN = rf"[A-Za-z0-9+/_-]{{{MIN_TOKEN},}}={{0,2}}"
FALSE_SHARE = 0.05
#: Decoys change between kinds of characters at most once in so many.
WORD_LENGTH = 4
_CHANGE = "(?=[a-z][A-Z]|[A-Za-z][0-9]|[0-9][A-Za-z])"
_BLOCK = 64
#: Stands for a token's characters within base spans; no pattern here matches it.
_MARK = "\x01"
#: p bins: 0 is below ``FLOOR``, then twentieths.
FLOOR, BINS = 0.001, 20

# Encodings, smallest alphabet first (name, pattern, alphabet).
ENCODINGS = (
    ("decimal", "^[0-9]+$", string.digits),
    ("hex", "^[0-9a-f]+$", "0123456789abcdef"),
    ("hex_upper", "^[0-9A-F]+$", "0123456789ABCDEF"),
    ("lower", "^[a-z]+$", string.ascii_lowercase),
    ("upper", "^[A-Z]+$", string.ascii_uppercase),
    ("base32", "^[A-Z2-7]+$", string.ascii_uppercase + "234567"),
    ("lower_alnum", "^[a-z0-9]+$", string.digits + string.ascii_lowercase),
    ("upper_alnum", "^[A-Z0-9]+$", string.digits + string.ascii_uppercase),
    ("alnum", "^[A-Za-z0-9]+$", string.digits + string.ascii_uppercase + string.ascii_lowercase),
    ("base64", "^[A-Za-z0-9+/]+$", string.ascii_uppercase + string.ascii_lowercase + string.digits + "+/"),
    ("base64url", "^[A-Za-z0-9_-]+$", string.ascii_uppercase + string.ascii_lowercase + string.digits + "-_"),
)
_ALL = string.ascii_uppercase + string.ascii_lowercase + string.digits + "+/-_"

_SPAN = "array<struct<start:bigint,kind:int,end:bigint>>"


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value worked out once: inside a lambda an expression is
    worked out again wherever it is written, but a lambda's variable isn't."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _matches(text: Column, pattern: str, filter_pattern: str, groups: tuple[int, ...]) -> Column:
    """Array of structs (start, end, g1..) of the leftmost non-overlapping matches.

    ``(.*?)(pattern)`` walks the text once; the end of text as the other branch keeps the
    walk linear.  Starts follow from the lengths of what was passed."""
    walk = F.lit(rf"(?s)(.*?)(?:({pattern})|\z)")
    gaps = F.transform(F.regexp_extract_all(text, walk, F.lit(1)), lambda g: F.length(g).cast("long"))
    parts = [F.regexp_extract_all(text, walk, F.lit(g)) for g in groups]
    rows = F.arrays_zip(gaps.alias("gap"), *(p.alias(f"g{g}") for g, p in zip(groups, parts, strict=True)))
    none = F.array().cast("array<struct<start:bigint,end:bigint,v:string>>")

    def add(acc, row):
        start = acc["at"] + row["gap"]
        end = start + F.length(row[f"g{groups[0]}"])
        one = F.struct(start.alias("start"), end.alias("end"), row[f"g{groups[-1]}"].alias("v"))
        return F.struct(end.alias("at"), F.when(end > start, F.concat(acc["out"], F.array(one))).otherwise(acc["out"]).alias("out"))

    def placed(rows):
        """Running starts by blocks, since an array that grows is copied at each step."""
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(rows) - 1) / _BLOCK).cast("int")), lambda g: F.slice(rows, g * _BLOCK + 1, F.lit(_BLOCK)))
        return _let(blocks, by_block)

    def by_block(blocks):
        sizes = F.transform(blocks, lambda b: F.aggregate(b, F.lit(0).cast("long"), lambda n, r: n + r["gap"] + F.length(r[f"g{groups[0]}"])))
        begin = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<bigint>").alias("out"))
        starts = F.aggregate(sizes, begin, lambda acc, n: F.struct((acc["at"] + n).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")), lambda acc: acc["out"])
        each = F.zip_with(blocks, starts, lambda b, at: F.aggregate(b, F.struct(at.alias("at"), none.alias("out")), add, lambda acc: acc["out"]))
        return F.flatten(each)

    found = _let(rows, placed)
    return F.when(text.rlike(filter_pattern), found).otherwise(none)


def _kind(spans: Column, kind: str) -> Column:
    k = KINDS.index(kind)
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(k).alias("kind"), s["end"].alias("end"))).cast(_SPAN)


def base_spans(text: Column) -> Column:
    """Base spans of a non-null text: structs (start, kind number, end), sorted."""
    assign = F.filter(_matches(text, ASSIGN, _NAME, (2, 3)), lambda m: F.length(m["v"]) >= MIN_VALUE)
    access = F.filter(_matches(text, ACCESS, "AKIA[A-Z0-9]{12}", (2,)), lambda m: m["end"] - m["start"] >= MIN_ACCESS)
    hexes = _matches(text, HEX, HEX, (2,))
    return F.array_sort(F.concat(_kind(assign, "assign"), _kind(access, "access"), _kind(hexes, "hex")))


def two_sided(z: Column) -> Column:
    """P(|Z| > |z|) of a normal Z, by the rational approximation of erfc (Abramowitz and
    Stegun 7.1.26; error below 2e-7)."""
    x = F.abs(z) / math.sqrt(2)
    t = 1 / (1 + 0.3275911 * x)
    # The approximation's coefficients.
    poly = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429))))
    return F.least(F.lit(1.0), poly * F.exp(-x * x))


def _alphabet(body: Column) -> Column:
    chosen = F.lit(_ALL)
    for _, pattern, letters in reversed(ENCODINGS):
        chosen = F.when(body.rlike(pattern), F.lit(letters)).otherwise(chosen)
    return chosen


def randomness_p(body: Column, alphabet: Column) -> Column:
    """Combined p-value of the three tests that ``body`` is random over ``alphabet``."""
    known = F.struct(body.alias("body"), alphabet.alias("alphabet"), F.length(body).cast("double").alias("n"), F.length(alphabet).cast("double").alias("k"))
    return _let(known, _randomness_p)


def _randomness_p(v: Column) -> Column:
    n, k = v["n"], v["k"]
    squares = F.aggregate(
        F.transform(F.split(v["alphabet"], ""), lambda c: n - F.length(F.replace(v["body"], c, F.lit("")))), F.lit(0.0), lambda a, c: a + c * c
    )
    z_chi = _let(squares, lambda x: (k / n * x - n - (k - 1)) / F.sqrt(2 * (k - 1) * (n - 1) / n))
    p_chi = _let(z_chi, lambda z: F.when(z > 0, two_sided(z)).otherwise(1.0))
    codes = F.transform(F.split(v["body"], ""), lambda c: (F.instr(v["alphabet"], c) - 1).cast("double"))
    zero = F.struct(*(F.lit(0.0).alias(x) for x in ("s", "ss", "ab", "high", "turns")))

    def add(t, x):
        up, up_next = (x["a"] >= k / 2), (x["b"] >= k / 2)
        return F.struct(
            (t["s"] + x["a"]).alias("s"),
            (t["ss"] + x["a"] * x["a"]).alias("ss"),
            (t["ab"] + F.coalesce(x["a"] * x["b"], F.lit(0.0))).alias("ab"),
            (t["high"] + up.cast("double")).alias("high"),
            (t["turns"] + F.coalesce((up != up_next).cast("double"), F.lit(0.0))).alias("turns"),
        )

    def over(c):
        both = F.zip_with(c, F.slice(c, F.lit(2), F.greatest(F.lit(1), F.size(c) - 1)), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
        ends = F.element_at(c, 1) + F.element_at(c, -1)
        return F.aggregate(both, F.struct(zero.alias("t"), ends.alias("ends")), lambda acc, x: F.struct(add(acc["t"], x).alias("t"), acc["ends"].alias("ends")))

    def tests(w):
        t = w["t"]
        mean = t["s"] / n
        spread = t["ss"] - n * mean * mean
        product = t["ab"] - mean * (2 * t["s"] - w["ends"]) + (n - 1) * mean * mean
        z_serial = (F.try_divide(product, spread) + 1 / n) * F.sqrt(n)
        pairs = 2 * t["high"] * (n - t["high"])
        variance = pairs * (pairs - n) / (n * n * (n - 1))
        z_runs = F.try_divide(t["turns"] - pairs / n, F.sqrt(F.when(variance > 0, variance)))
        return _let(F.struct(z_runs.alias("runs"), z_serial.alias("serial")), lambda z: F.least(F.coalesce(two_sided(z["runs"]), F.lit(0.0)), F.coalesce(two_sided(z["serial"]), F.lit(0.0))))

    return F.least(F.lit(1.0), 3 * F.least(p_chi, _let(_let(codes, over), tests)))


def _marked_tokens(text: Column, pattern: str, group: int, least: int) -> Column:
    """The text's tokens with their characters marked where they lie in a match of
    ``pattern`` whose ``group`` has ``least`` characters; and the empty one at the end."""
    plain = F.translate(text, _MARK, "\n")
    walk = F.lit(rf"(?s)(.*?)(?:({pattern})|\z)")
    gaps, found, sized = (F.regexp_extract_all(plain, walk, F.lit(g)) for g in (1, 2, group))
    rows = F.arrays_zip(gaps.alias("gap"), found.alias("m"), sized.alias("v"))
    marked = F.transform(rows, lambda r: F.concat(r["gap"], F.when(F.length(r["v"]) >= least, F.translate(r["m"], _ALL, _MARK * len(_ALL))).otherwise(r["m"])))
    token = TOKEN.replace("[A-Za-z0-9+/_-]", f"[A-Za-z0-9+/_{_MARK}-]")
    return F.regexp_extract_all(F.array_join(marked, ""), F.lit(rf"(?s)(.*?)(?:({token})|\z)"), F.lit(2))


def candidates(text: Column, base: Column) -> Column:
    """Tokens clear of base spans: structs (start, end, target, length class, p bin)."""
    tokens = _matches(text, TOKEN, TOKEN, (2,))
    # Marks replace token characters by token characters, so token i stays token i.
    marks = [_marked_tokens(text, *kind) for kind in ((ASSIGN, 3, MIN_VALUE), (ACCESS, 2, MIN_ACCESS), (HEX, 2, 1))]
    beside = F.arrays_zip(tokens.alias("token"), *(m.alias(f"m{k}") for k, m in enumerate(marks)))
    untouched = F.filter(beside, lambda x: x["token"].isNotNull() & ~F.contains(F.concat(*(F.coalesce(x[f"m{k}"], F.lit("")) for k in range(3))), F.lit(_MARK)))
    clear = F.when(F.size(base) == 0, tokens).otherwise(F.transform(untouched, lambda x: x["token"]))

    def judge(m):
        return _let(F.regexp_replace(m["v"], "=+$", ""), lambda body: _let(randomness_p(body, _alphabet(body)), lambda p: judged(m, body, p)))

    def judged(m, body, p):
        wordy = F.regexp_count(body, F.lit(_CHANGE)) * WORD_LENGTH <= F.length(body)
        target = body.rlike("[A-Za-z]") & (body.rlike("[0-9]") | body.rlike("[a-z][A-Z]"))
        return F.struct(
            m["start"].alias("start"),
            m["end"].alias("end"),
            F.when(wordy & body.rlike("[A-Za-z]"), F.lit(0)).when(target, F.lit(1)).alias("target"),
            F.floor(F.log2(F.length(body))).cast("int").alias("size"),
            F.when(p < FLOOR, F.lit(0)).otherwise(1 + F.floor(p * BINS)).cast("int").alias("bin"),
        )

    return F.transform(clear, judge)


def thresholds(docs: DataFrame, text: str = "text", false_share: float = FALSE_SHARE) -> dict[int, int]:
    """Length class -> smallest accepted p bin, from counts over all texts.  The share of
    false ones is estimated by (decoys + 1) / targets, so without decoys it is not zero."""
    t = F.coalesce(F.col(text), F.lit(""))
    found = docs.where(t.rlike(TOKEN)).select(F.explode(candidates(t, base_spans(t))).alias("c"))
    counts = found.where("c.target is not null").groupBy("c.size", "c.bin").agg(F.sum(F.col("c.target")).alias("targets"), F.sum(1 - F.col("c.target")).alias("decoys")).collect()
    out: dict[int, int] = {}
    for size in sorted({r["size"] for r in counts}):
        targets = decoys = 0
        for r in sorted((r for r in counts if r["size"] == size and r["bin"] > 0), key=lambda r: -r["bin"]):
            targets, decoys = targets + r["targets"], decoys + r["decoys"]
            if decoys + 1 <= false_share * targets:
                out[size] = r["bin"]
    return out


def find_secrets(docs: DataFrame, text: str = "text", into: str = "secrets", least: dict[int, int] | None = None) -> DataFrame:
    """All columns of ``docs`` plus ``into``: sorted structs (start, kind number, end),
    in code points, end exclusive; ``KINDS`` names the kinds."""
    least, into = thresholds(docs, text) if least is None else least, fresh(docs, into)
    t, b = fresh(docs, "t"), fresh(docs, "b")
    out = docs.withColumn(t, F.coalesce(F.col(text), F.lit(""))).withColumn(b, base_spans(F.col(t)))
    if not least:
        return out.withColumn(into, F.col(b)).select(*docs.columns, into)
    bar = F.lit(None).cast("int")

    def passes(c):
        need = bar
        for size, least_bin in least.items():
            need = F.when(c["size"] == size, F.lit(least_bin)).otherwise(need)
        return (c["target"] == 1) & (c["bin"] >= need)

    extra = F.when(F.col(t).rlike(TOKEN), _kind(F.filter(candidates(F.col(t), F.col(b)), passes), "random"))
    both = F.array_sort(F.concat(F.col(b), F.coalesce(extra, F.array().cast(_SPAN))))
    return out.withColumn(into, both).select(*docs.columns, into)


def _written(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", names[s["kind"]], s["start"], s["end"])), ",")


def redact(docs: DataFrame, text: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with each secret in ``text`` replaced by ``mark``; overlapping spans get
    one.  Rows without secrets, and null texts, stay as they are."""
    into = fresh(docs, "secrets")
    kept, chars = (fresh(docs, c) for c in ("kept", "chars"))
    zero = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<a:int,b:int,last:boolean>>").alias("out"))

    def add(acc, s):
        """The stretch between what is covered so far and a span that starts after it."""
        gap = F.struct(acc["at"].cast("int").alias("a"), s["start"].cast("int").alias("b"), F.lit(False).alias("last"))
        clear = s["start"] >= acc["at"]
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.when(clear, F.concat(acc["out"], F.array(gap))).otherwise(acc["out"]).alias("out"))

    def end(acc):
        return F.concat(acc["out"], F.array(F.struct(acc["at"].cast("int").alias("a"), F.length(F.col(text)).alias("b"), F.lit(True).alias("last"))))

    found = find_secrets(docs, text, into)
    some = F.size(into) > 0
    found = found.withColumn(kept, F.when(some, F.aggregate(F.col(into), zero, add, end))).withColumn(chars, F.when(some, F.split(F.col(text), "")))
    # Slices of the characters, since finding a place in a string means walking to it.
    parts = F.transform(kept, lambda g: F.concat(F.slice(F.col(chars), g["a"] + 1, g["b"] - g["a"]), F.when(g["last"], F.array().cast("array<string>")).otherwise(F.array(F.lit(mark)))))
    clean = F.when(F.size(chars) > 0, F.array_join(F.flatten(parts), ""))
    return found.withColumn(text, F.coalesce(clean, F.col(text))).select(*docs.columns)


def report(docs: DataFrame) -> DataFrame:
    """The query's digest: one row per document with counts, checksum and spans."""
    found = find_secrets(docs.select("doc_id", "text"))
    spans = F.col("secrets")
    base = F.filter(spans, lambda s: s["kind"] < 3)

    def count(k):
        return F.size(F.filter(spans, lambda s: s["kind"] == k)).cast("long")

    return found.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(_written(base).cast("binary"), 256).alias("base_sha256"),
        _written(spans).alias("spans"),
    )
