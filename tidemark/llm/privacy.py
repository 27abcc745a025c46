"""Personal data and the terms that reveal it (native: DataFrame functions only).

Base detectors find e-mail addresses, IP addresses, card and phone numbers by pattern. Information-theoretic sanitisation adds the terms that give such an
entity away: for a term t and an entity e that stand in the same document,

    PMI(t; e) = log2(N * df(t, e) / (df(t) * df(e)))        IC(e) = -log2(df(e) / N)

with document frequencies over the whole corpus. PMI is at most IC, and equal to it when t occurs with e alone. A term with PMI / IC of at least ``disclosure``
tells that much of what the entity's own presence would tell: it is a span of kind ``term`` wherever it stands, in any document. Terms at or above ``removal`` are removed
by ``sanitise``, the others are generalised, as the base spans are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored

#: Base detectors: kind, cheap test, pattern. The look-arounds only keep a search from starting again inside a run that has failed
#: already; the matches are those of the plain patterns.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
CARD = r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){15,18}(?![\x20-]?[0-9])"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
KINDS = ("email", "ip", "card", "phone")
#: A stored table with at most so many rows is broadcast, a larger one is left to the planner.
BROADCAST_ROWS = 200_000
_NO_TERM = r"\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F"


_STRIDE = 256


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once; inside a lambda an expression is computed anew for every element."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _places(text: Column, pattern: str) -> Column:
    """Start, end and text of the leftmost non-overlapping matches, from the texts between them.

    An array that grows in an ``aggregate`` is copied at every step, so the running place is kept over strides of matches and, inside a
    stride, over its few matches.
    """
    between, matches = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pairs = F.zip_with(F.slice(between, 1, F.size(matches)), matches, lambda b, m: F.struct(F.char_length(b).alias("gap"), m.alias("m")))
    none = F.array().cast("array<struct<start:int,end:int,match:string>>")

    def strides(own: Column) -> Column:
        count = F.floor((F.size(own) - 1) / _STRIDE).cast("int")
        return F.transform(F.sequence(F.lit(0), count), lambda i: F.slice(own, i * _STRIDE + 1, F.lit(_STRIDE)))

    def length(own: Column) -> Column:
        return F.aggregate(own, F.lit(0), lambda n, p: n + p["gap"] + F.char_length(p["m"]))

    def begin(acc: Column, own: Column) -> Column:
        here = F.struct(acc["at"].alias("at"), own.alias("own"))
        return F.struct((acc["at"] + length(own)).alias("at"), F.concat(acc["out"], F.array(here)).alias("out"))

    def add(acc: Column, p: Column) -> Column:
        first = acc["at"] + p["gap"]
        last = first + F.char_length(p["m"])
        return F.struct(last.alias("at"), F.concat(acc["out"], F.array(F.struct(first.alias("start"), last.alias("end"), p["m"].alias("match")))).alias("out"))

    no_stride = F.array().cast("array<struct<at:int,own:array<struct<gap:int,m:string>>>>")
    begun = F.aggregate(_let(pairs, strides), F.struct(F.lit(0).alias("at"), no_stride.alias("out")), begin, lambda acc: acc["out"])
    placed = F.transform(begun, lambda s: F.aggregate(s["own"], F.struct(s["at"].alias("at"), none.alias("out")), add, lambda acc: acc["out"]))
    return F.when(F.size(matches) > 0, F.flatten(placed)).otherwise(none)


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    marks = F.filter(F.split(F.reverse(digits), ""), lambda c: c != "")

    def value(c: Column, i: Column) -> Column:
        d = c.cast("int") * F.when(i % 2 == 1, 2).otherwise(1)
        return F.when(d > 9, d - 9).otherwise(d)

    return F.aggregate(F.transform(marks, value), F.lit(0), lambda a, d: a + d) % 10 == 0


def _valid(kind: str, match: Column) -> Column:
    n = F.char_length(_digits(match))
    if kind == "ip":
        part = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
        return match.rlike(rf"^{part}(?:\.{part}){{3}}$")
    if kind == "card":
        return n.between(16, 19) & _luhn(_digits(match))
    return n.between(8, 15) if kind == "phone" else F.lit(True)


def base_spans(text: Column, kind: str) -> Column:
    """Valid matches of one kind as an array of (start, end, match), end exclusive, in code points."""
    pattern = {"email": EMAIL, "ip": IP, "card": CARD, "phone": PHONE}[kind]
    maybe = {"email": F.contains(text, F.lit("@")), "phone": F.contains(text, F.lit("+"))}.get(kind, text.rlike(pattern))
    none = F.array().cast("array<struct<start:int,end:int,match:string>>")
    return F.when(maybe, F.filter(_places(text, pattern), lambda m: _valid(kind, m["match"]))).otherwise(none)


def _terms(text: Column) -> Column:
    """The distinct terms of a text as they are written."""
    return F.array_distinct(F.filter(F.split(text, rf"[{_NO_TERM}]+"), lambda t: t != ""))


def _outside(text: Column, base: Column) -> Column:
    """The distinct lower-case terms of a text that overlap no base span."""
    spans = F.array_sort(F.transform(base, lambda b: F.struct(b["start"].alias("start"), b["end"].alias("end"))))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def piece(first: Column, last: Column) -> Column:
        """The text between two spans with a character of either, so that a term which runs into a span is seen to do so."""
        left = F.when(first > 0, 1).otherwise(0)
        return F.when(last >= first, F.substring(text, first + 1 - left, last - first + left + 1)).otherwise(F.lit(""))

    def cut(acc: Column, s: Column) -> Column:
        own = F.regexp_replace(piece(acc["at"], s["start"]), rf"(?<![^{_NO_TERM}])[^{_NO_TERM}]++$", "")
        own = F.when(acc["at"] > 0, F.regexp_replace(own, rf"^[^{_NO_TERM}]++", "")).otherwise(own)
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.concat(acc["out"], F.array(own)).alias("out"))

    def end(acc: Column) -> Column:
        rest = F.regexp_replace(piece(acc["at"], F.char_length(text)), rf"^[^{_NO_TERM}]++", "")
        return F.concat(acc["out"], F.array(rest))

    return F.array_distinct(F.transform(_terms(F.array_join(F.aggregate(spans, start, cut, end), " ")), F.lower))


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def disclosing_terms(base: DataFrame, support: int, disclosure: float) -> DataFrame:
    """(entity, term, ratio) for the pairs whose PMI reaches ``disclosure`` of the entity's information content.

    ``base`` has the columns row, text and base. A pair must stand together in at least ``support`` documents, so entities in fewer have none.
    """
    total = base.count()
    private = base.filter(F.size("base") > 0)
    owners = private.select("row", F.explode(F.array_distinct(F.transform("base", lambda b: b["entity"]))).alias("entity"))
    entities = owners.groupBy("entity").agg(F.count(F.lit(1)).alias("df_entity")).filter(F.col("df_entity") >= support)
    entities = stored(entities, "entities")
    shared = owners.join(entities.select("entity"), "entity", "left_semi").groupBy(F.col("row").alias("r")).agg(F.collect_list("entity").alias("entities"))
    learned = private.join(_small(stored(shared, "shared-entities")), F.col("row") == F.col("r")).select("entities", _outside(F.col("text"), F.col("base")).alias("terms"))
    learned = stored(learned, "learned-terms")
    # Counted per task first, here and below: what is shuffled is a row per task and distinct pair or term.
    pairs = learned.select("terms", F.explode("entities").alias("entity")).select("entity", F.explode("terms").alias("term"))
    pairs = pairs.groupBy("entity", "term").agg(F.count(F.lit(1)).alias("both")).filter(F.col("both") >= support)
    information = F.log2(F.lit(float(total)) / F.col("df_entity"))

    def ratio_at(df_term: str) -> Column:
        pmi = F.log2(F.lit(float(total)) * F.col("both") / (F.col(df_term) * F.col("df_entity")))
        return F.when(information > 0, pmi / information).otherwise(F.lit(0.0))

    # A term stands in at least as many documents as in those with a shared entity. Pairs that fall short even so are out before the corpus is counted.
    least = learned.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df_least"))
    pairs = pairs.join(entities, "entity").join(least, "term").filter(ratio_at("df_least") >= disclosure)
    pairs = stored(pairs.drop("df_least"), "term-pairs")
    wanted = stored(pairs.select("term").distinct(), "wanted-terms")
    terms = base.select(F.explode(F.array_distinct(F.transform(_terms(F.col("text")), F.lower))).alias("word"))
    frequency = terms.join(_small(wanted), F.col("word") == F.col("term"), "left_semi").groupBy("word").agg(F.count(F.lit(1)).alias("df_term"))
    ratio = ratio_at("df_term")
    return pairs.join(frequency, F.col("term") == F.col("word")).select("entity", "term", ratio.alias("ratio")).filter(F.col("ratio") >= disclosure)


def personal_data(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    support: int = 2,
    disclosure: float = 0.9,
) -> DataFrame:
    """One row per input row: doc_id, base (array of kind, start, end) and terms (array of start, end, ratio), sorted.

    Null counts as empty. Repeated rows are documents of their own; null ids are kept. A span of one kind may overlap one of
    another. A term is marked at every place in every document, with its greatest ratio to any entity; places that overlap a base span are left out.
    """
    plain = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    found = plain.select("doc_id", "text", *(base_spans(F.col("text"), k).alias(k) for k in KINDS))
    def tagged(kind: str) -> Column:
        def tag(m: Column) -> Column:
            entity = F.concat_ws(":", F.lit(kind), F.lower(m["match"]))
            return F.struct(F.lit(kind).alias("kind"), m["start"].alias("start"), m["end"].alias("end"), entity.alias("entity"))

        return F.transform(kind, tag)

    every = F.concat(*map(tagged, KINDS))
    base = stored(found.select("doc_id", "text", every.alias("base")).withColumn("row", F.monotonically_increasing_id()), "personal-data")
    reveals = disclosing_terms(base, support, disclosure).groupBy(F.col("term").alias("t")).agg(F.max("ratio").alias("ratio"))
    reveals = stored(reveals, "disclosing-terms")
    written = base.select("row", F.explode(_terms(F.col("text"))).alias("written"))
    hits = written.join(_small(reveals), F.lower("written") == F.col("t"))
    hits = hits.groupBy(F.col("row").alias("r")).agg(F.map_from_entries(F.collect_list(F.struct("written", "ratio"))).alias("ratios"))
    hits = stored(hits, "documents-with-terms")
    # No text travels while the rows with a hit are few; otherwise only the texts with one do.
    texts = base.join(_small(hits), F.col("row") == F.col("r"))
    any_of = F.concat(F.lit(rf"(?<![^{_NO_TERM}])(?:"), F.array_join(F.map_keys("ratios"), "|"), F.lit(rf")(?![^{_NO_TERM}])"))
    free = F.filter(_places(F.col("text"), any_of), lambda m: ~F.exists("base", lambda b: (b["start"] < m["end"]) & (m["start"] < b["end"])))
    terms = F.transform(free, lambda m: F.struct(m["start"].alias("start"), m["end"].alias("end"), F.col("ratios")[m["match"]].alias("ratio")))
    marked = texts.select("r", terms.alias("terms"))
    none = F.array().cast("array<struct<start:int,end:int,ratio:double>>")
    spans = F.transform("base", lambda b: F.struct(b["kind"].alias("kind"), b["start"].alias("start"), b["end"].alias("end")))
    return base.select("doc_id", "row", "base").join(marked, F.col("row") == F.col("r"), "left").select(
        "doc_id", spans.alias("base"), F.coalesce("terms", none).alias("terms")
    )


def report(found: DataFrame) -> DataFrame:
    """Counts by kind, the digest of the base spans, and all spans, of ``personal_data``."""
    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda b: b["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.transform("base", lambda b: F.concat_ws(":", b["kind"], b["start"], b["end"]))
    terms = F.transform("terms", lambda t: F.concat_ws(":", F.lit("term"), t["start"], t["end"]))
    return found.select(
        "doc_id",
        *map(count, KINDS),
        F.sha2(F.concat_ws(",", base).cast("binary"), 256).alias("base_sha256"),
        F.concat_ws(",", F.concat(base, terms)).alias("spans"),
        F.size("terms").cast("long").alias("n_term"),
    )


def sanitise(text: Column, base: Column, terms: Column, removal: float = 0.98) -> Column:
    """The text with base spans replaced by their kind in brackets and terms removed or replaced by [TERM].

    Where spans overlap, the one that begins first wins, and of those the longest.
    """
    every = F.concat(
        F.transform(base, lambda b: F.struct(b["start"].alias("start"), (-b["end"]).alias("last"), F.concat(F.lit("["), F.upper(b["kind"]), F.lit("]")).alias("put"))),
        F.transform(terms, lambda t: F.struct(t["start"].alias("start"), (-t["end"]).alias("last"), F.when(t["ratio"] >= removal, F.lit("")).otherwise(F.lit("[TERM]")).alias("put"))),
    )
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def put(acc: Column, s: Column) -> Column:
        kept = F.substring(text, acc["at"] + 1, s["start"] - acc["at"])
        done = F.struct((-s["last"]).alias("at"), F.concat(acc["out"], kept, s["put"]).alias("out"))
        return F.when(s["start"] >= acc["at"], done).otherwise(acc)

    return F.aggregate(F.array_sort(every), start, put, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.char_length(text))))
