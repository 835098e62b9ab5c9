"""Secrets in texts: fixed patterns, and a battery of randomness tests on long tokens.

Only DataFrame functions run on the rows. The method:

1. A token is a run of at least 20 letters, digits and + / _ -, with its padding.
   Its encoding is inferred (decimal, hex, base 32, base 64).
2. Three tests of randomness against that alphabet: chi-squared of the symbol
   counts, number of runs above and below the alphabet's middle, and lag-one
   serial correlation. Each gives a z value; the misfit is the sum of their
   squares, small for random strings.
3. Plain words (letters in one case) of a length class are the null: they say how
   misfit natural tokens of that length are. A token's p value is the chance that
   a natural token fits a random string as well as it does.
4. Within each length class the false-discovery rate is held by the step-up rule
   on a histogram of the misfits, whose size does not grow with the input.

Defined results: a null text is empty; an empty table gives an empty result; rows
that repeat, also with the same id, each get their own result; null ids stay;
other columns, whatever their names, are not touched.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.llm import spans as sp
from larder.llm.common import fresh, stored, text_of

# The patterns of the three base kinds, with the least lengths.
ASSIGN = (
    r"(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]"
    r"|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])"
    r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ASSIGN_VALUE = 8
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
KINDS = ("assign", "access", "hex")

TOKEN = r"[A-Za-z0-9+/_-]{20,}={0,2}"
SHORTEST = 20
# Whether a token occurs, in one pass: whole runs that are too short are skipped.
HAS_TOKEN = (
    r"\A(?:[^A-Za-z0-9+/_-]*+[A-Za-z0-9+/_-]{1,19}+(?![A-Za-z0-9+/_-]))*+"
    r"[^A-Za-z0-9+/_-]*+[A-Za-z0-9+/_-]{20}"
)
# Alphabets in the order of their codes.
ALPHABETS = {
    "dec": "0123456789",
    "hex": "0123456789abcdef",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
}
LENGTH_CLASSES = 12
BINS_PER_UNIT = 8
LOWEST, HIGHEST = -12.0, 24.0

FDR = 0.01
# What is known about natural tokens before any was seen counts as so many of them.
PRIOR_WEIGHT = 20.0
PRIOR_SPREAD = 0.6


def flags(text: Column) -> dict[str, Column]:
    """Cheap tests that every text with a span of a kind passes.

    A hex run of 32 is a token, and an assignment holds one of two signs.
    """
    return {
        "token": text.rlike(HAS_TOKEN),
        "assign": (text.contains("=") | text.contains(":")) & text.rlike(ASSIGN),
        "access": text.contains("AKIA"),
    }


def base_spans(text: Column, flag: dict[str, Column]) -> dict[str, Column]:
    """Spans of the three base kinds, matched only in texts that may hold them."""
    return {
        "assign": sp.spans_where(flag["assign"], sp.match_spans(
            text, ASSIGN, lambda value: F.length(value) >= ASSIGN_VALUE, group=1)),
        "access": sp.spans_where(flag["access"], sp.match_spans(text, ACCESS)),
        "hex": sp.spans_where(flag["token"], sp.match_spans(text, HEX)),
    }


def _pick(encoding: Column, of) -> Column:
    """A value by encoding."""
    value = F.lit(None)
    for name, alphabet in ALPHABETS.items():
        value = F.when(encoding == name, of(alphabet)).otherwise(value)
    return value


def _with(t: Column, names: list[str], **new: Column) -> Column:
    """A struct with some fields of another one and new fields."""
    return F.struct(*[t[n].alias(n) for n in names], *[c.alias(n) for n, c in new.items()])


KEPT = ["start", "end", "plain"]
PLAIN_WORD = r"^([A-Za-z]?[a-z]+|[A-Z]+)$"


def _encoded(t: Column) -> Column:
    """The token without padding, its encoding, and its symbols written as the alphabet does."""
    bare = F.regexp_replace(t["token"], "=+$", "")
    encoding = (
        F.when(bare.rlike("^[0-9]+$"), "dec").when(bare.rlike("^([0-9a-f]+|[0-9A-F]+)$"), "hex")
        .when(bare.rlike("^[A-Z2-7]+$"), "base32").otherwise("base64")
    )
    return F.struct(t["start"].alias("start"), t["end"].alias("end"), t["token"].rlike(PLAIN_WORD).alias("plain"),
                    encoding.alias("encoding"), bare.alias("bare"))


def _spelled(t: Column) -> Column:
    string = F.when(t["encoding"] == "hex", F.lower(t["bare"])).otherwise(F.translate(t["bare"], "-_", "+/"))
    return _with(t, [*KEPT, "encoding"], string=string)


def _symbols(t: Column) -> Column:
    """Symbols of the token, its length, and the half of the alphabet that each lies in."""
    halves = _pick(t["encoding"], lambda a: F.translate(
        t["string"], a, "L" * (len(a) // 2) + "H" * (len(a) - len(a) // 2)))
    return _with(
        t, [*KEPT, "string"], halves=halves, n=F.length(t["string"]).cast("double"),
        chars=F.filter(F.split(t["string"], ""), lambda c: c != ""),
        alphabet=_pick(t["encoding"], lambda a: F.lit(a)), size=_pick(t["encoding"], lambda a: F.lit(float(len(a)))),
    )


def _sums(t: Column) -> Column:
    """What the tests need from one walk over the token."""
    n = t["n"]
    squares = F.aggregate(F.array_distinct(t["chars"]), F.lit(0.0), lambda total, c: total + F.pow(
        n - F.length(F.replace(t["string"], c, F.lit(""))), F.lit(2.0)))
    codes = F.transform(t["chars"], lambda c: F.instr(t["alphabet"], c).cast("double"))
    sums = F.aggregate(
        codes,
        F.struct(F.lit(0.0).alias("x"), F.lit(0.0).alias("xx"), F.lit(0.0).alias("xy"), F.lit(0.0).alias("last")),
        lambda s, x: F.struct(
            (s["x"] + x).alias("x"), (s["xx"] + x * x).alias("xx"), (s["xy"] + s["last"] * x).alias("xy"),
            x.alias("last"),
        ),
    )
    low = F.length(F.replace(t["halves"], F.lit("H"), F.lit(""))).cast("double")
    changes = (2 * n - F.length(F.replace(t["halves"], F.lit("LH"), F.lit("")))
               - F.length(F.replace(t["halves"], F.lit("HL"), F.lit("")))) / 2
    return _with(t, [*KEPT, "n", "size"], squares=squares, sums=sums, low=low, changes=changes,
                 first=F.instr(t["alphabet"], t["chars"][0]).cast("double"))


def _tested(t: Column) -> Column:
    """Length class and misfit: the logarithm of the squared z values of the three tests."""
    n, size, s = t["n"], t["size"], t["sums"]
    chi_z = (size / n * t["squares"] - n - (size - 1)) / F.sqrt(2 * (size - 1) * (n - 1) / n)

    both = 2 * t["low"] * (n - t["low"])
    spread = both * (both - n) / (n * n * (n - 1))
    runs_z = F.when(spread > 0, (t["changes"] - both / n) / F.sqrt(spread)).otherwise(F.sqrt(n))

    mean = s["x"] / n
    variance = s["xx"] - n * mean * mean
    # Sum of (x_i - mean)(x_i+1 - mean) from the sums over the whole token.
    lagged = s["xy"] - mean * (2 * s["x"] - t["first"] - s["last"]) + (n - 1) * mean * mean
    serial_z = F.when(variance > 1e-9, (lagged / variance + 1 / n) * F.sqrt(n)).otherwise(F.sqrt(n))

    total = chi_z * chi_z + runs_z * runs_z + serial_z * serial_z
    misfit = F.greatest(F.lit(LOWEST), F.least(F.lit(HIGHEST), F.log(total + F.lit(1e-5))))
    length_class = F.least(F.lit(LENGTH_CLASSES - 1), F.greatest(
        F.lit(0), F.floor(2 * F.log2(n / SHORTEST)).cast("int")))
    return _with(t, KEPT, length_class=length_class, misfit=misfit)


def tokens(text: Column, flag: Column) -> Column:
    """Long tokens of a text: span, whether it is a plain word, length class, misfit.

    The steps are separate, as a function over an array evaluates whatever it
    names once per element: each step only names fields of the one before.
    """
    found = F.transform(sp.match_spans(text, TOKEN), lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"),
        F.substring(text, s["start"] + 1, s["end"] - s["start"]).alias("token")))
    for step in (_encoded, _spelled, _symbols, _sums, _tested):
        found = F.transform(found, step)
    kind = "array<struct<start:int,end:int,plain:boolean,length_class:int,misfit:double>>"
    return F.when(flag, found).otherwise(F.array().cast(kind))


def cutoffs(found: DataFrame, tokens_column: str, fdr: float = FDR) -> list[float | None]:
    """The largest misfit that counts as random, for each length class.

    One aggregation to a histogram of a fixed number of cells over all tokens;
    only that reaches the driver.
    """
    t = F.col("t")
    cell = F.floor(t["misfit"] * BINS_PER_UNIT).cast("int")
    cells = (
        found.select(F.explode(tokens_column).alias("t"))
        .groupBy(t["length_class"].alias("c"), t["plain"].alias("plain"), cell.alias("cell"))
        .agg(F.count("*").alias("k"), F.sum(t["misfit"]).alias("s"), F.sum(t["misfit"] * t["misfit"]).alias("ss"))
        .collect()
    )
    return [_cutoff([r for r in cells if r.c == c], c, fdr) for c in range(LENGTH_CLASSES)]


def _cutoff(cells: list, length_class: int, fdr: float) -> float | None:
    """Step-up rule on the cells of one length class."""
    length = SHORTEST * 2 ** (length_class / 2)
    k, s, ss = (sum(v) for v in zip((0, 0.0, 0.0), *((r.k, r.s, r.ss) for r in cells if r.plain)))
    prior = math.log(5 * length)
    weight = k + PRIOR_WEIGHT
    mean = (s + PRIOR_WEIGHT * prior) / weight
    square = (ss + PRIOR_WEIGHT * (PRIOR_SPREAD ** 2 + prior ** 2)) / weight
    spread = math.sqrt(max(square - mean * mean, 0.04))
    tested: dict[int, int] = {}
    for r in cells:
        if not r.plain:
            tested[r.cell] = tested.get(r.cell, 0) + r.k
    total, seen, best = sum(tested.values()), 0, None
    for cell in sorted(tested):
        seen += tested[cell]
        edge = (cell + 1) / BINS_PER_UNIT
        p = 0.5 * math.erfc((mean - edge) / (spread * math.sqrt(2)))
        if total * p <= fdr * seen:
            best = edge
    return best


def random_spans(tokens_: Column, limits: list[float | None], base: dict[str, Column]) -> Column:
    """Spans of the tokens that are random and do not overlap a base span."""
    def kept(t: Column) -> Column:
        bound = F.lit(-1e9)
        for c, v in enumerate(limits):
            if v is not None:
                bound = F.when(t["length_class"] == c, F.lit(v)).otherwise(bound)
        free = F.lit(True)
        for spans in base.values():
            free = free & ~F.exists(spans, lambda s: (s["start"] < t["end"]) & (t["start"] < s["end"]))
        return ~t["plain"] & (t["misfit"] < bound) & free

    return F.transform(F.filter(tokens_, kept), lambda t: F.struct(t["start"].alias("start"), t["end"].alias("end")))


def _flagged(docs: DataFrame, text_column: str) -> tuple[DataFrame, Column, dict[str, Column]]:
    """Docs with the flags as columns of their own, so that each test runs once."""
    text = text_of(text_column)
    found = flags(text)
    names = dict(zip(found, fresh(docs, *found)))
    return docs.withColumns({names[k]: c for k, c in found.items()}), text, {k: F.col(n) for k, n in names.items()}


def scan(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", fdr: float = FDR) -> DataFrame:
    """Secrets of every text: counts and digest of the base spans, and all spans.

    Reads the texts once; spans and test results are stored without them.
    """
    marked, text, flag = _flagged(docs.select(id_column, text_column), text_column)
    found = stored(marked.select(
        F.col(id_column).alias("id"),
        *[c.alias(k) for k, c in base_spans(text, flag).items()],
        tokens(text, flag["token"]).alias("tokens"),
    ))
    base = {k: F.col(k) for k in KINDS}
    extra = random_spans(F.col("tokens"), cutoffs(found, "tokens", fdr), base)
    every = sp.as_text(sp.in_order(base | {"random": extra}))
    return found.select(
        F.col("id").alias(id_column),
        *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(sp.as_text(sp.in_order(base)), 256).alias("base_sha256"),
        every.alias("spans"),
    )


def redact(
    docs: DataFrame, text_column: str = "text", length_column: str | None = None, fdr: float = FDR,
) -> DataFrame:
    """The same rows with every secret in the text replaced by a mark of its kind.

    Where a text changes, its characters are counted anew in the length column, if one is named.
    """
    marked, text, flag = _flagged(docs, text_column)
    limits = cutoffs(marked.where(flag["token"]).select(tokens(text, F.lit(True)).alias("tokens")), "tokens", fdr)
    base = base_spans(text, flag)
    names = dict(zip([*base, "tokens"], fresh(marked, *base, "tokens")))
    marked = marked.withColumns({names[k]: c for k, c in (base | {"tokens": tokens(text, flag["token"])}).items()})
    base = {k: F.col(names[k]) for k in base}
    every = sp.in_order(base | {"random": random_spans(F.col(names["tokens"]), limits, base)})
    [spans] = fresh(marked, "spans")
    marked = marked.withColumn(spans, every)
    clean = sp.replaced(text, F.col(spans), lambda kind: F.concat(F.lit("<secret:"), kind, F.lit(">")))
    touched = flag["token"] | flag["assign"] | flag["access"]
    [new] = fresh(marked, "clean")
    marked = marked.withColumn(new, F.when(touched, clean).otherwise(F.col(text_column)))
    columns = {text_column: F.col(new)}
    if length_column is not None:
        kind = docs.schema[length_column].dataType
        columns[length_column] = F.when(touched & F.col(text_column).isNotNull(), F.length(new).cast(kind)).otherwise(
            F.col(length_column))
    return marked.select(*[columns.get(c, F.col(c)).alias(c) for c in docs.columns])
