"""Personal data in texts, and the words around it that give it away.

Only DataFrame functions run on the rows. E-mail addresses, IP addresses, card and
phone numbers are found by patterns with checks; they are the protected entities,
one for each distinct value.

Words beside an entity may reveal it. Over the distinct texts of the corpus, p(e) is the
share that holds the entity e, and p(e|t) the share that holds e among those that hold
the word t, taken at the lower end of its 95 % interval (Wilson), so that little evidence
counts little whatever the size of the corpus. A word discloses an entity if that bound
reaches 0.4 and tells at least three bits more than p(e) does; it is then sanitised wherever
it occurs, in all texts: a capitalised word is generalised to a name, one with digits to
a number, any other is removed. Copies of one text count once. One text is no evidence
(its bound is 0.27), two texts that share an entity and a word that occurs nowhere else are. So
only entities in two texts or more are paired with words, only words met twice beside
one are counted over the corpus, and unrelated texts don't change a verdict.

The patterns are possessive and start only where a run starts, so that long runs
cost linear time and no stack; they match what the plain forms would.

Defined results: a null text is empty; rows that repeat, also with the same id, get
their own results; null ids stay; an empty table gives an empty result; other columns
are not touched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.llm import spans as sp
from larder.llm.common import checkpointed, stored, text_of

# The four base kinds.
KINDS = ("email", "ip", "card", "phone")
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
LONG_NUMBER = r"[0-9](?:[\x20-]?[0-9]){13}"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
CARD_DIGITS, PHONE_DIGITS = (14, 19), (10, 15)

TERM = r"\p{L}[\p{L}\p{N}]{2,}+"
TERM_KINDS = ("name", "number", "term")
DISCLOSURE = 0.4
LEAST_BITS = 3.0
Z = 1.645
BROADCAST_KEYS = 1_000_000


# --- base kinds -----------------------------------------------------------

def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _few_digits(match: Column, bounds: tuple[int, int]) -> Column:
    return F.length(_digits(match)).between(*bounds)


def _luhn(match: Column) -> Column:
    """The check of card numbers: from the right, every second digit counts double."""
    digits = F.filter(F.split(F.reverse(_digits(match)), ""), lambda d: d != "")

    def value(digit: Column, i: Column) -> Column:
        d = digit.cast("int")
        return F.when(i % 2 == 0, d).when(d > 4, 2 * d - 9).otherwise(2 * d)

    return F.aggregate(F.transform(digits, value), F.lit(0), lambda a, d: a + d) % 10 == 0


def _octets(match: Column) -> Column:
    def small(part: Column) -> Column:
        bare = F.regexp_replace(part, "^0+", "")
        return (F.length(bare) < 3) | ((F.length(bare) == 3) & (bare <= "255"))

    return F.forall(F.split(match, r"\."), small)


def base_spans(text: Column) -> dict[str, Column]:
    """Spans of the four base kinds, matched only in texts that may hold them."""
    return {
        "email": sp.spans_where(text.contains("@"), sp.match_spans(text, EMAIL)),
        "ip": sp.spans_where(text.rlike(r"[0-9]\.[0-9]"), sp.match_spans(text, IP, _octets)),
        "card": sp.spans_where(text.rlike(LONG_NUMBER), sp.match_spans(
            text, CARD, lambda m: F.when(_few_digits(m, CARD_DIGITS), _luhn(m)))),
        "phone": sp.spans_where(text.contains("+"), sp.match_spans(
            text, PHONE, lambda m: _few_digits(m, PHONE_DIGITS))),
    }


# --- words that disclose entities -----------------------------------------

def _blanked(text: Column, spans: Column) -> Column:
    """The text with spaces in place of its spans, which are in order of starts."""
    def step(state: Column, span: Column) -> Column:
        open_from = F.greatest(state["at"], span["start"])
        before = F.substring(text, state["at"] + 1, F.greatest(span["start"] - state["at"], F.lit(0)))
        blank = F.repeat(F.lit(" "), F.greatest(span["end"] - open_from, F.lit(0)))
        return F.struct(
            F.greatest(state["at"], span["end"]).alias("at"),
            F.concat(state["out"], F.array(F.concat(before, blank))).alias("out"),
        )

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    return F.when(F.size(spans) == 0, text).otherwise(F.aggregate(spans, start, step, lambda state: F.concat(
        F.array_join(state["out"], ""), F.substring(text, state["at"] + 1, F.length(text)))))


def _term(word: Column) -> Column:
    return F.xxhash64(F.lower(word))


def _terms(text: Column, spans: Column) -> Column:
    """The different words outside of the base spans, as hashes."""
    words = F.regexp_extract_all(_blanked(text, spans), F.lit(TERM), F.lit(0))
    return F.array_distinct(F.transform(words, _term))


def _found(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """Stored: row number, id, text, hash of the text, base spans by kind and all in order."""
    text = text_of(text_column)
    based = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_column).alias("id"), text.alias("text"),
        F.xxhash64(text).alias("context"), *[c.alias(k) for k, c in base_spans(text).items()],
    )
    return stored(based.withColumn("base", sp.in_order({k: F.col(k) for k in KINDS})))


def _met(rows: DataFrame, key: str, others: DataFrame, how: str = "inner") -> DataFrame:
    """The rows joined to others on a key: by a broadcast of at most a million narrow rows, else by a shuffle."""
    few = others.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS
    return rows.join(F.broadcast(others) if few else others, key, how)


def _among(rows: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    """The rows whose key is one of the keys."""
    return _met(rows, key, keys.select(key).distinct(), "left_semi")


def lower_bound(both: Column, n: Column) -> Column:
    """The lower end of the 95 % interval of a share, by Wilson."""
    share, n = both / n, n.cast("double")
    middle = share + Z * Z / (2 * n)
    return (middle - Z * F.sqrt(share * (1 - share) / n + Z * Z / (4 * n * n))) / (1 + Z * Z / n)


def candidates(found: DataFrame, disclosure: float = DISCLOSURE) -> DataFrame:
    """Stored: entity, term, texts of the entity, and texts with both, where these are two or more.

    Entities that occur in the same texts have the same terms and are judged as one, by
    the least of them. A word in so many texts with entities that no entity beside it could
    reach the disclosure is left out before pairs are formed, and so is one in a single
    text. Neither loses a term.
    """
    own = found.where(F.size("base") > 0).select("row", "context", "text", "base")
    value = lambda s: F.xxhash64(
        s["kind"], F.substring(F.col("text"), s["start"] + 1, s["end"] - s["start"]))
    held = checkpointed(
        own.select("context", F.explode(F.array_distinct(F.transform("base", value))).alias("entity")).distinct())
    entities = held.groupBy("entity").agg(
        F.count("*").alias("texts"), F.sum(F.xxhash64("context").cast("decimal(38,0)")).alias("where"))
    judged = entities.where("texts > 1").groupBy("texts", "where").agg(F.min("entity").alias("entity")).select("entity", "texts")
    held = checkpointed(held.join(judged, "entity"))
    once = checkpointed(_among(own.select("row", "context"), "context", held).groupBy("context").agg(F.min("row").alias("row")))
    terms = _among(own, "row", once).select("context", F.explode(_terms(F.col("text"), F.col("base"))).alias("term"))
    counts = checkpointed(terms.groupBy("term").agg(F.count("*").alias("here")).where("here > 1"))
    both = _met(_met(terms, "term", counts), "context", held).where(F.col("here") * disclosure <= F.col("texts"))
    return stored(both.groupBy("entity", "term").agg(
        F.count("*").alias("both"), F.first("texts").alias("texts")).where("both > 1"))


def occurrences(found: DataFrame, pairs: DataFrame) -> DataFrame:
    """Stored: row, context and term wherever a term of the pairs occurs; the only pass over all words."""
    terms = F.explode(_terms(F.col("text"), F.col("base"))).alias("term")
    return stored(_among(found.select("row", "context", terms), "term", pairs))


def disclosing(
    found: DataFrame, pairs: DataFrame, places: DataFrame, disclosure: float = DISCLOSURE, least_bits: float = LEAST_BITS,
) -> DataFrame:
    """Pairs of entity and term where the term discloses the entity."""
    total = max(1, found.select("context").distinct().count())
    counts = places.select("term", "context").distinct().groupBy("term").agg(F.count("*").alias("n"))
    share = lower_bound(F.col("both"), F.col("n"))
    gained = F.log2(share / (F.col("texts") / total))
    return pairs.join(counts, "term").where((share >= disclosure) & (gained >= least_bits)).select("entity", "term")


def _with_terms(docs: DataFrame, id_column: str, text_column: str, disclosure: float) -> DataFrame:
    """The found table with all spans of each row in the column `every`."""
    found = _found(docs, id_column, text_column)
    pairs = candidates(found, disclosure)
    places = occurrences(found, pairs)
    hidden = stored(disclosing(found, pairs, places, disclosure).select("term").distinct())
    text, base = F.col("text"), F.col("base")
    hits = stored(_among(places, "term", hidden).groupBy("row").agg(F.collect_list("term").alias("hidden")))

    def kind(span: Column) -> Column:
        word = F.substring(text, span["start"] + 1, span["end"] - span["start"])
        of = F.when(word.rlike(r"\p{N}"), "number").when(word.rlike(r"\A\p{Lu}"), "name").otherwise("term")
        return F.struct(span["start"].alias("start"), span["end"].alias("end"), of.alias("kind"))

    spans = sp.match_spans(_blanked(text, base), TERM, lambda word: F.array_contains("hidden", _term(word)))
    some = _among(found.select("row", "text", "base"), "row", hits)
    terms = some.join(hits, "row").select("row", F.transform(spans, kind).alias("terms"))
    by_kind = {k: F.col(k) for k in KINDS}
    extra = {k: F.coalesce(F.transform(
        F.filter("terms", _is(k)), lambda t: F.struct(t["start"].alias("start"), t["end"].alias("end"))
    ), F.array().cast(sp.SPAN_TYPE)) for k in TERM_KINDS}
    return found.join(terms, "row", "left").withColumn("every", sp.in_order(by_kind | extra))


def _is(kind: str):
    return lambda t: t["kind"] == kind


def scan(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    disclosure: float = DISCLOSURE,
) -> DataFrame:
    """Personal data of every text: counts and digest of the base spans, and all spans."""
    found = _with_terms(docs, id_column, text_column, disclosure)
    return found.select(
        F.col("id").alias(id_column), *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(sp.as_text(sp.in_order({k: F.col(k) for k in KINDS})), 256).alias("base_sha256"),
        sp.as_text(F.col("every")).alias("spans"),
    )


def sanitised(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    disclosure: float = DISCLOSURE,
) -> DataFrame:
    """Id and text with entities, names and numbers generalised and other disclosing words removed."""
    found = _with_terms(docs, id_column, text_column, disclosure)
    mask = lambda kind: F.when(kind == "term", F.lit("")).otherwise(
        F.concat(F.lit("<"), kind, F.lit(">")))
    return found.select(F.col("id").alias(id_column), sp.replaced(F.col("text"), F.col("every"), mask).alias(text_column))
