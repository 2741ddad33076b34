"""Secret scans (DataFrame functions only): fixed patterns, and a battery of randomness tests on other tokens.

A token of 20 characters or more with letters and digits is read in the encoding that its characters allow (hex, base
32, base 36 or base 64; dashes between groups of the first three are left out, if half of the groups hold a digit or all
is hex, and 20 characters remain). Three tests ask if its symbol values are uniform and independent: chi-squared over equally
likely bins, runs above and below the middle, and lag-1 serial correlation. A token that one of them rejects at GATE / 3 isn't
random.

A token that passes is a discovery only if it couldn't be an ordinary identifier. That null hypothesis bounds how often
such a name (in camel case, with dashes, dates and numbers) has a letter that is rare in words (in hex: one of a to f), changes
between words, cases and digits, and has two consonants in a row; each count has an exact binomial tail, and Fisher's method joins the
three. Benjamini-Hochberg over all tokens of the table, with weights in proportion to length, then holds the share of
ordinary names among the reported tokens at FDR: longer tokens carry more evidence and get more of the allowance. Tokens that a
fixed pattern reports anyway are no candidates: they count neither as tests nor as discoveries, so FDR is the share among the spans
that the battery adds. The threshold comes from counts by evidence, of which there are LEVELS at most.

Spans count code points, end exclusive. Patterns are cut out with their positions by one anchored expression: each match
takes the gap before it along.

Defined results: null is the empty text, without spans; fixed patterns are matched row by row, and ties between kinds go in
the order of KINDS; repeated rows and tokens count each time; an empty table, or one without tokens, has no threshold and
reports fixed patterns only; a very long token takes time in proportion to its length, and so does a text of up to some ten thousand
matches (from there on, the blocks of BLOCK matches that each match is held against show); extra columns pass through, and one
called `secrets` is replaced.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finlake.llm.common import let, named, no_clash

KINDS = ("assign", "access", "hex", "random")
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
TOKEN = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}"
#: Level of the three randomness tests together, share of ordinary names among the reported tokens, and steps of evidence (ten to
#: a factor of ten) that the threshold is chosen from.
GATE, FDR, LEVELS = 0.003, 0.01, 3000
#: Under the null hypothesis, how often at most: a letter of a name is rare, or one of a to f; a pair of its characters is a
#: change; a pair of letters is two consonants.
RARE, LIKE_HEX, CHANGE, CONSONANTS = 0.09, 0.35, 0.18, 0.42
#: Matches of a text that are placed, or looked through, together.
BLOCK = 256
_SPANS = "cast(array() as array<struct<start: int, end: int, kind: int, token: string>>)"
_UPPER, _LOWER, _DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
#: Encoding: characters allowed, symbols in order of value, symbols a bin.
ENCODINGS = {
    "hex": (r"^(?:[0-9a-f]+|[0-9A-F]+)$", _DIGITS + "abcdef", 2),
    "base32": (r"^[A-Z2-7]+$", _LOWER + "234567", 4),
    "base36": (r"^(?:[0-9a-z]+|[0-9A-Z]+)$", _DIGITS + _LOWER, 4),
    "base64": (r"^[A-Za-z0-9+/_-]+$", _UPPER + _LOWER + _DIGITS + "+/", 8),
}


def in_blocks(items: Column, of: Callable[[Column], Column]) -> Column:
    """`of` each BLOCK items, in order."""
    count = F.ceil(F.size(items) / BLOCK).cast("int")
    numbers = F.when(count > 0, F.sequence(F.lit(0), F.greatest(count - 1, F.lit(0)))).otherwise(F.expr("cast(array() as array<int>)"))
    return F.transform(numbers, lambda b: of(F.slice(items, b * BLOCK + 1, F.lit(BLOCK))))


def located(text: Column, pattern: str, kind: str) -> Column:
    """Spans of the leftmost non-overlapping matches, in order: placed within blocks of matches, which are then placed in the text."""
    anchored = F.lit(rf"(?s)\G(.*?)(?:{pattern})")

    def place(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["gap"]
        end = acc["at"] + F.length(x["whole"])
        span = F.struct(start.alias("start"), end.alias("end"), F.lit(KINDS.index(kind)).alias("kind"), F.substr(x["whole"], x["gap"] + 1).alias("token"))
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(span)).alias("out"))

    def shifted(block: Column, by: Column) -> Column:
        return F.transform(block["out"], lambda s: F.struct((s["start"] + by).alias("start"), (s["end"] + by).alias("end"), s["kind"].alias("kind"), s["token"].alias("token")))

    def joined(blocks: Column) -> Column:
        none = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<int>)").alias("out"))
        begins = F.aggregate(blocks, none, lambda acc, b: F.struct((acc["at"] + b["at"]).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")), lambda acc: acc["out"])
        return F.flatten(F.zip_with(blocks, begins, shifted))

    found = F.zip_with(
        F.regexp_extract_all(text, anchored, F.lit(0)),
        F.regexp_extract_all(text, anchored, F.lit(1)),
        lambda whole, gap: F.struct(whole.alias("whole"), F.length(gap).alias("gap")),
    )
    start = F.struct(F.lit(0).alias("at"), F.expr(_SPANS).alias("out"))
    spans = let(found, lambda f: let(in_blocks(f, lambda block: F.aggregate(block, start, place)), joined))
    return F.when(text.rlike(pattern), spans).otherwise(F.expr(_SPANS))


def upper_tail(z: Column) -> Column:
    """The normal distribution's upper tail, within 0.3 percent of it for z > 0."""
    y = F.abs(z)
    tail = F.exp(-y * y / 2) / (1.64 * y + F.sqrt(0.76 * y * y + 4))
    return F.when(z >= 0, tail).otherwise(1 - tail)


def binomial_tail(k: Column, n: Column, rate: float) -> Column:
    """The chance of `k` or more of `n`, exactly; 1 where `k` isn't above the mean."""
    ways = F.aggregate(F.sequence(F.lit(1), F.greatest(k, F.lit(1)).cast("int")), F.lit(0.0), lambda acc, j: acc + F.log((n - j + 1) / j))
    here = F.exp(ways + k * math.log(rate) + (n - k) * math.log(1 - rate))
    start = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("sum"))

    def more(acc: Column, i: Column) -> Column:
        term = acc["term"] * (n - i) / (i + 1) * (rate / (1 - rate))
        return F.struct(term.alias("term"), (acc["sum"] + term).alias("sum"))

    rest = F.aggregate(F.sequence(k.cast("int"), F.greatest(n, k).cast("int")), start, more, lambda acc: acc["sum"])
    return F.when(k <= n * rate, F.lit(1.0)).otherwise(F.least(F.lit(1.0), here * rest))


def ordinary_p(token: Column) -> Column:
    """How likely an ordinary identifier has at least so many rare letters, changes and pairs of consonants."""

    def of(letters: Column) -> Column:
        pairs = F.transform(F.slice(letters, 1, F.greatest(F.size(letters) - 1, F.lit(1))), lambda c, i: F.struct(c.alias("a"), F.coalesce(F.get(letters, i + 1), F.lit("-")).alias("b")))
        return let(pairs, lambda p: tests(letters, p))

    def tests(letters: Column, pairs: Column) -> Column:
        is_, count = (lambda c, kind: c.rlike(kind)), (lambda x, f: F.size(F.filter(x, f)).cast("double"))
        change = lambda x: (is_(x["a"], "[a-z]") & is_(x["b"], "[A-Z]")) | (is_(x["a"], "[0-9]") != is_(x["b"], "[0-9]"))
        signs = F.filter(pairs, lambda x: is_(x["a"], "[A-Za-z0-9]") & is_(x["b"], "[A-Za-z0-9]"))
        within = F.filter(signs, lambda x: ~change(x) & is_(x["a"], "[A-Za-z]"))
        consonant = "(?i)[b-df-hj-np-tv-z]"
        n_letters = count(letters, lambda c: is_(c, "[A-Za-z]"))
        hex_ = F.translate(token, "-", "").rlike(ENCODINGS["hex"][0])
        rare = F.when(hex_, binomial_tail(n_letters, n_letters, LIKE_HEX)).otherwise(binomial_tail(count(letters, lambda c: is_(c, "[jkqvwxyzJKQVWXYZ]")), n_letters, RARE))
        changes = binomial_tail(count(signs, change), F.size(signs).cast("double"), CHANGE)
        serial = F.when(hex_, F.lit(1.0)).otherwise(binomial_tail(count(within, lambda x: is_(x["a"], consonant) & is_(x["b"], consonant)), F.size(within).cast("double"), CONSONANTS))
        joined = -(F.log(F.greatest(rare, F.lit(1e-90))) + F.log(F.greatest(changes, F.lit(1e-90))) + F.log(F.greatest(serial, F.lit(1e-90))))
        return let(joined, lambda x: F.exp(-x) * (1 + x + x * x / 2))  # Fisher's method: chi-squared with 6 degrees

    return let(F.filter(F.split(token, ""), lambda c: F.length(c) > 0), of)


def p_value(values: Column, symbols: int, per_bin: int) -> Column:
    """The battery's p-value (three times the least of three) for symbol values 0..symbols-1: small if they aren't uniform and independent."""
    n, bins = F.size(values).cast("double"), symbols // per_bin
    expected = n / bins
    count = lambda b: F.size(F.filter(values, lambda v: F.floor(v / per_bin) == b)).cast("double")
    zero = F.lit(0.0)
    chi = F.aggregate(F.sequence(F.lit(0), F.lit(bins - 1)), zero, lambda acc, b: acc + (count(b) - expected) * (count(b) - expected) / expected)
    k = float(bins - 1)
    chi_p = upper_tail((F.pow(F.greatest(chi, F.lit(1e-9)) / k, F.lit(1 / 3)) - (1 - 2 / (9 * k))) / (2 / (9 * k)) ** 0.5)

    high = lambda v: v >= symbols / 2
    highs = F.size(F.filter(values, high)).cast("double")
    lows = n - highs
    pairs = F.slice(F.transform(values, lambda v, i: F.struct(v.alias("a"), F.coalesce(F.get(values, i + 1), v).alias("b"))), F.lit(1), F.greatest(F.size(values) - 1, F.lit(1)))
    runs = 1 + F.size(F.filter(pairs, lambda x: high(x["a"]) != high(x["b"]))).cast("double")
    mean_runs = 2 * highs * lows / n + 1
    var_runs = (mean_runs - 1) * (mean_runs - 2) / (n - 1)
    runs_p = F.when((highs < 2) | (lows < 2), F.lit(1e-9)).otherwise(2 * upper_tail(F.abs(runs - mean_runs) / F.sqrt(F.greatest(var_runs, F.lit(0.1)))))

    mean = F.aggregate(values, zero, lambda acc, v: acc + v) / n
    power = F.aggregate(values, zero, lambda acc, v: acc + (v - mean) * (v - mean))
    shared = F.aggregate(pairs, zero, lambda acc, x: acc + (x["a"] - mean) * (x["b"] - mean))
    serial = F.when(power <= 0, F.lit(1e-9)).otherwise(2 * upper_tail(F.abs(shared / F.greatest(power, F.lit(1e-9)) + 1 / n) * F.sqrt(n)))
    return F.least(F.lit(1.0), 3 * F.least(chi_p, runs_p, serial))


def token_p(token: Column) -> Column:
    bare = F.translate(token, "-", "")
    groups = F.split(token, "-")
    grouped = (F.length(bare) >= 20) & (2 * F.size(F.filter(groups, lambda g: g.rlike("[0-9]"))) >= F.size(groups))

    def scored(symbols: str, per_bin: int) -> Column:
        plain = F.translate(token, "_-", "/+") if len(symbols) == 64 else bare
        letters = F.split(F.lower(plain) if symbols.lower() == symbols else plain, "")
        values = F.transform(F.filter(letters, lambda c: F.length(c) > 0), lambda c: F.instr(F.lit(symbols), c).cast("double") - 1.0)
        return let(values, lambda v: p_value(v, len(symbols), per_bin))

    out = F.lit(0.0)
    for name, (allowed, symbols, per_bin) in reversed(ENCODINGS.items()):
        fits = token.rlike(allowed) if name == "base64" else bare.rlike(allowed) & (F.length(bare) >= 20 if name == "hex" else grouped)
        out = F.when(fits, scored(symbols, per_bin)).otherwise(out)
    return out


def assigned(text: Column) -> Column:
    """Spans of assignments whose value is long enough."""
    return F.filter(located(text, ASSIGN, "assign"), lambda s: F.length(F.regexp_extract(s["token"], ASSIGN, 2)) >= 6)


def tokens(text: Column, assign: Column | None = None) -> Column:
    """Candidates as spans with p: their p-value as ordinary names over their length, or 1 for those that aren't random. Tokens that
    overlap a fixed pattern's span are none. An access or hex match is a part of one token, as all its characters are a token's;
    assignments (`assign`, if at hand) are held against tokens by place."""
    apart = lambda s: ~s["token"].rlike(ACCESS) & ~s["token"].rlike(HEX)
    mixed = F.filter(located(text, TOKEN, "random"), lambda s: s["token"].rlike("[0-9]") & s["token"].rlike("[A-Za-z]") & apart(s))

    def judged(s: Column) -> Column:
        weighted = F.when(token_p(s["token"]) >= GATE, ordinary_p(s["token"]) / F.length(s["token"])).otherwise(F.lit(1.0))
        return F.struct(weighted.alias("p"), s.alias("s"))

    def left(blocks: Column) -> Column:
        within = lambda b, s: (b["start"] < s["end"]) & (s["start"] < b["end"])
        free = F.filter(mixed, lambda s: ~F.exists(blocks, lambda b: within(b, s) & F.exists(b["spans"], lambda x: within(x, s))))
        return let(free, lambda spans: F.transform(spans, judged))

    block = lambda spans: F.struct(F.element_at(spans, 1)["start"].alias("start"), F.element_at(spans, -1)["end"].alias("end"), spans.alias("spans"))
    return let(assigned(text) if assign is None else assign, lambda a: let(in_blocks(a, block), left))


def threshold(df: DataFrame, text: str = "text", fdr: float = FDR) -> float:
    """The largest p over length that Benjamini-Hochberg with weights in proportion to length reports over the whole table;
    -1 if there is none."""
    body = named(text)
    each = df.where(body.rlike(TOKEN)).select(F.explode(tokens(body)).alias("x")).select("x.p", F.length("x.s.token").alias("n"))
    level = F.least(F.floor(-10 * F.log10(F.greatest(F.col("p"), F.lit(1e-299)))), F.lit(LEVELS)).cast("int")
    counts = each.groupBy(level.alias("level")).agg(F.count("*").alias("k"), F.sum("n").alias("n")).collect()
    m, length = sum(r["k"] for r in counts), sum(r["n"] for r in counts)
    found, best = 0, -1.0
    for r in sorted(counts, key=lambda r: -r["level"]):
        found += r["k"]
        p = 10 ** (-r["level"] / 10)  # no token of this level has more
        if p < 1 and m * p * (length / m) <= fdr * found:
            best = p
    return best


def random_tokens(text: Column, most: float, assign: Column | None = None) -> Column:
    """Spans of candidates whose p over length is `most` or less."""
    if most < 0:
        return F.expr(_SPANS)
    return F.transform(F.filter(tokens(text, assign), lambda x: x["p"] <= most), lambda x: x["s"])


def scan_secrets(df: DataFrame, text: str = "text", most: float | None = None) -> DataFrame:
    """`df` with secrets: array of (start, end, kind, token) by start, then kind. most: the threshold, if another table's is
    to be used."""
    most = threshold(df, text) if most is None else most
    body = F.coalesce(named(text), F.lit(""))

    def joined(assign: Column) -> Column:
        every = F.concat(assign, located(body, ACCESS, "access"), located(body, HEX, "hex"), random_tokens(body, most, assign))
        ordered = F.sort_array(F.transform(every, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"), s["token"].alias("token"))))
        return F.transform(ordered, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.element_at(F.array(*map(F.lit, KINDS)), s["kind"] + 1).alias("kind"), s["token"].alias("token")))

    return no_clash(df, "secrets").withColumn("secrets", let(assigned(body), joined))


def span_list(secrets: Column) -> Column:
    return F.array_join(F.transform(secrets, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
