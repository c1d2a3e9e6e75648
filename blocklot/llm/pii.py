r"""Information-theoretic sanitisation of personal data (operator 2), DataFrame functions only.

*Protected entities*: e-mail addresses, IPv4 addresses, card numbers (13 to 19 digits
that pass Luhn) and phone numbers (9 to 15 digits), the leftmost non-overlapping
matches of each kind. The patterns are the stated ones, written so that matching
is linear in the text and never recursive.

*Terms*: runs of three or more letters, in lower case, outside all entities (an
entity ends a run). Every term of a document counts, however far it stands from
the entity.

*Disclosure*: with document counts over the whole corpus, a term t reveals an
entity e by their pointwise mutual information as a share of the information in e:

    disclosure(t, e) = log(N n_te / (n_t n_e)) / log(N / n_e)

It is 1 when every document with t has e, and 0 or less when t tells nothing. A
pair counts only when at least ``SUPPORT`` different texts show it: one text (or its
copies) is no evidence. A term counts by the entity that it reveals most of: from
``GENERALISE`` on it is generalised (first letter and an asterisk), from ``REMOVE`` on
it is removed, at every occurrence in every document, whether or not the entity
stands there too. Entities are replaced by their kind.

*Plan*: one scan finds entities, and the distinct terms of texts that have any, and
writes them (no texts). Only entities of ``SUPPORT`` texts are paired with terms, per
distinct text, so a group of copies costs one row. Counts are partial aggregates.
The terms of the corpus are joined to those that can be disclosing, or are, by a
broadcast where those take at most ``BROADCAST_BYTES``, by a shuffle where they take
more. The documents then meet the entities and disclosing terms of their text.

Defined results: a null text is empty and has no spans. Repeated rows give repeated
results. A null doc_id is carried along. Empty tables give an empty result. Other
columns are not read (``sanitise`` keeps them).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import col, free_name, materialise, read_table

SUPPORT = 2
GENERALISE, REMOVE = 0.6, 0.9
#: Most that the terms of a broadcast may take, with ``ROW_BYTES`` for each.
BROADCAST_BYTES, ROW_BYTES = 16 << 20, 64
KINDS = ("email", "ip", "card", "phone")
TERM = r"\p{L}{3,}+"
#: The stated patterns. Possessive: the classes that meet don't overlap, so backtracking finds nothing more.
#: A match of email or ip that fails from the start of a run fails from inside it too, so only run
#: starts and the end of the last match are tried. A card run is taken whole or not at all.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){12,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must contain to be worth the pattern.
HINTS = {"email": "@", "ip": ".", "card": None, "phone": "+"}
SPAN = "struct<kind:string,start:int,end:int,value:string>"


def bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often ``use`` refers to it, in lambdas too."""
    return F.element_at(F.transform(F.array(value), use), 1)


def prefixes(values: Column, join, zero: Column) -> Column:
    """Of each of ``values``, what ``join`` makes of those before it (``zero`` where there are none).

    In blocks of about the square root of their number, as arrays grow by copying: n values cost n ** 1.5 steps.
    """
    start = F.struct(zero.alias("at"), F.array_remove(F.array(zero), zero).alias("out"))

    def walk(items: Column) -> Column:
        return F.aggregate(items, start, lambda acc, x: F.struct(
            join(acc["at"], x).alias("at"), F.array_append(acc["out"], acc["at"]).alias("out")))

    def blocks(items: Column) -> Column:
        size = F.greatest(F.ceil(F.sqrt(F.size(items))).cast("int"), F.lit(1))
        return F.transform(F.sequence(F.lit(0), F.floor((F.size(items) - 1) / size).cast("int")),
                           lambda k: walk(F.slice(items, k * size + 1, size)))

    def flat(within: Column) -> Column:
        bases = walk(F.transform(within, lambda w: w["at"]))["out"]
        return F.flatten(F.zip_with(within, bases, lambda w, base: F.transform(w["out"], lambda x: join(base, x))))

    return bound(bound(values, blocks), flat)


def spans_of(text: Column, pattern: str) -> Column:
    """(start, value) of the matches of ``pattern``, from the lengths of the pieces between them."""
    none = F.array().cast("array<struct<start:int,value:string>>")

    def located(found: Column) -> Column:
        parts = F.zip_with(F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found)), found, lambda p, m: F.struct(
            F.length(p).alias("gap"), F.length(m).alias("size"), m.alias("value")))
        return bound(parts, lambda lengths: F.zip_with(
            lengths, prefixes(F.transform(lengths, lambda x: x.gap + x["size"]), lambda a, b: a + b, F.lit(0)),
            lambda x, at: F.struct((at + x.gap).alias("start"), x.value.alias("value"))))

    return bound(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
                 lambda found: F.when(F.size(found) > 0, located(found)).otherwise(none))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _small(part: Column) -> Column:
    short = F.ltrim(part, F.lit("0"))
    return (F.length(short) <= 3) & (F.coalesce(short.cast("int"), F.lit(0)) <= 255)


def _luhn(digits: Column) -> Column:
    n = F.length(digits)
    doubled = F.transform(F.sequence(F.lit(1), n), lambda i: F.when(
        i % 2 == 0, digits.substr(n - i + 1, F.lit(1)).cast("int") * 2).otherwise(
        digits.substr(n - i + 1, F.lit(1)).cast("int")))
    total = F.aggregate(doubled, F.lit(0), lambda a, d: a + F.when(d > 9, d - 9).otherwise(d))
    return total % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(value, r"\."), _small)
    if kind == "card":
        return _luhn(_digits(value))
    if kind == "phone":
        return F.length(_digits(value)).between(9, 15)
    return F.lit(True)


def _same(kind: str, value: Column) -> Column:
    """The entity behind a written form."""
    return F.lower(value) if kind == "email" else value if kind == "ip" else _digits(value)


def entities(text: Column, kind: str) -> Column:
    """Spans of one kind, in order."""
    hint = HINTS[kind]
    found = spans_of(text, PATTERNS[kind])
    checked = F.transform(F.filter(found, lambda x: _valid(kind, x.value)), lambda x: F.struct(
        F.lit(kind).alias("kind"), x.start.alias("start"), (x.start + F.length(x.value)).alias("end"),
        _same(kind, x.value).alias("value")))
    none = F.array().cast(f"array<{SPAN}>")
    return checked if hint is None else F.when(F.contains(text, F.lit(hint)), checked).otherwise(none)


def _masked(text: Column) -> Column:
    """``text`` with blanks in the place of its e-mail addresses, all other characters where they were.

    Of the entities only these have letters.
    """
    pattern = PATTERNS["email"]
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pieces = F.split(text, pattern, -1)
    cut = F.zip_with(pieces, found, lambda p, m: F.concat(p, F.coalesce(F.repeat(F.lit(" "), F.length(m)), F.lit(""))))
    return F.when(F.contains(text, F.lit(HINTS["email"])), F.array_join(cut, "")).otherwise(text)


def _terms(text: Column) -> Column:
    """The distinct terms of ``text``."""
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(TERM), F.lit(0)), lambda w: F.lower(w)))


def _names(base: Column) -> Column:
    return F.array_distinct(F.transform(base, lambda b: F.concat(b.kind, F.lit(":"), b.value)))


def _digest(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, digest, base, terms, inner, cut) of each row, written to the shared folder; no text.

    ``terms`` stand outside the entities, ``inner`` are runs of the whole text that are no such terms,
    ``cut`` terms that are no run of the whole text. All three are null where ``base`` is empty.
    """
    text = F.coalesce(col(docs, "text"), F.lit(""))
    rows = docs.select(col(docs, "doc_id").alias("doc_id"), text.alias("text"))
    found = rows.select("doc_id", "text", _digest(F.col("text")).alias("digest"),
                        F.concat(*[entities(F.col("text"), k) for k in KINDS]).alias("base"))
    some = F.size("base") > 0
    both = found.select("doc_id", "digest", "base", F.when(some, _terms(_masked(F.col("text")))).alias(
        "terms"), F.when(some, _terms(F.col("text"))).alias("runs"))
    return materialise(both.select(
        "doc_id", "digest", "base", "terms", F.array_except("runs", "terms").alias("inner"),
        F.array_except("terms", "runs").alias("cut")), "pii-scan")


def _is_small(wanted: DataFrame) -> bool:
    """Whether the terms of ``wanted`` may be broadcast, from their measured size."""
    n = wanted.agg(F.sum(F.octet_length("term") + ROW_BYTES)).first()[0]
    return (n or 0) <= BROADCAST_BYTES


def _meet(every: DataFrame, wanted: DataFrame) -> DataFrame:
    """Rows of ``every`` whose term is in ``wanted`` (one row a term), with its columns."""
    return every.join(F.broadcast(wanted) if _is_small(wanted) else wanted, "term")


def _corpus_counts(docs: DataFrame, scanned: DataFrame, wanted: DataFrame) -> DataFrame:
    """(term, n_t): documents with each term of ``wanted`` (term), over all of ``docs``."""
    every = docs.select(F.explode(_terms(col(docs, "text"))).alias("term")).select("term", F.lit(1).alias("n"))
    for name, n in (("inner", -1), ("cut", 1)):
        every = every.unionByName(scanned.select(F.explode(name).alias("term")).select("term", F.lit(n).alias("n")))
    if _is_small(wanted):
        every = every.join(F.broadcast(wanted), "term", "left_semi")
        return every.groupBy("term").agg(F.sum("n").alias("n_t"))
    return every.groupBy("term").agg(F.sum("n").alias("n_t")).join(wanted, "term", "left_semi")


def disclosures(docs: DataFrame, scanned: DataFrame) -> DataFrame:
    """(entity, term, disclosure) of the pairs that reach ``GENERALISE``."""
    n = scanned.count()
    texts = materialise(scanned.where(F.size("base") > 0).groupBy("digest").agg(
        F.count(F.lit(1)).alias("n"), F.first(F.struct(_names(F.col("base")).alias("names"), "terms")).alias("x")).select(
        "digest", "n", "x.names", "x.terms"), "pii-texts")
    named = texts.select("digest", "n", F.explode("names").alias("entity"))
    owners = materialise(named.groupBy("entity").agg(F.sum("n").alias("n_e"), F.count(F.lit(1)).alias("texts")).where(
        (F.col("texts") >= SUPPORT) & (F.col("n_e") < n)).select("entity", "n_e"), "pii-owners")
    paired = named.join(owners, "entity", "left_semi").groupBy("digest").agg(F.collect_list("entity").alias("names"))
    pairs = texts.select("digest", "n", "terms").join(paired, "digest").select(
        "n", "terms", F.explode("names").alias("entity")).select("n", "entity", F.explode("terms").alias("term"))
    joint = materialise(pairs.groupBy("entity", "term").agg(
        F.sum("n").alias("n_te"), F.count(F.lit(1)).alias("texts")).where(F.col("texts") >= SUPPORT), "pii-joint")
    terms = materialise(_corpus_counts(docs, scanned, materialise(
        joint.select("term").distinct(), "pii-wanted")), "pii-terms")
    known = joint.join(terms, "term").join(owners, "entity")
    share = F.log(F.lit(float(n)) * F.col("n_te") / (F.col("n_t") * F.col("n_e"))) / F.log(F.lit(float(n)) / F.col("n_e"))
    return known.select("entity", "term", share.alias("disclosure")).where(F.col("disclosure") >= GENERALISE)


def telling_terms(docs: DataFrame, scanned: DataFrame) -> DataFrame:
    """(digest, telling): per distinct text with disclosing terms, the disclosure of each, whatever entity it reveals."""
    telling = materialise(disclosures(docs, scanned).groupBy("term").agg(
        F.max("disclosure").alias("disclosure")), "pii-telling")
    text = F.coalesce(col(docs, "text"), F.lit(""))
    # In two steps: beside an explode the digest would be computed for each term.
    every = docs.select(_digest(text).alias("digest"), _terms(text).alias("terms")).select(
        "digest", F.explode("terms").alias("term")).unionByName(scanned.select("digest", F.explode("cut").alias("term")))
    hits = _meet(every, telling).groupBy("digest", "term").agg(F.first("disclosure").alias("disclosure"))
    return hits.groupBy("digest").agg(F.map_from_entries(F.collect_list(F.struct("term", "disclosure"))).alias("telling"))


def _term_spans() -> Column:
    """(start, end, disclosure) of every occurrence of the terms of ``telling``: ``runs`` are found between ``pieces``."""
    parts = F.zip_with(F.slice("pieces", F.lit(1), F.size("runs")), "runs", lambda p, m: F.struct(
        F.length(p).alias("gap"), F.length(m).alias("size"), F.try_element_at("telling", F.lower(m)).alias("disclosure")))
    spans = bound(parts, lambda lengths: F.zip_with(
        lengths, prefixes(F.transform(lengths, lambda x: x.gap + x["size"]), lambda a, b: a + b, F.lit(0)),
        lambda x, at: F.struct((at + x.gap).alias("start"), (at + x.gap + x["size"]).alias("end"),
                               x.disclosure.alias("disclosure"))))
    none = F.array().cast("array<struct<start:int,end:int,disclosure:double>>")
    return F.when(F.col("telling").isNotNull() & (F.size("runs") > 0), F.filter(
        spans, lambda x: x.disclosure.isNotNull())).otherwise(none)


def find(docs: DataFrame) -> DataFrame:
    """(doc_id, digest, base, found) of each row of ``docs``: entity spans, and spans of disclosing terms."""
    scanned = scan(docs)
    based = scanned.where(F.size("base") > 0).groupBy("digest").agg(F.first("base").alias("base"))
    known = materialise(based.join(telling_terms(docs, scanned), "digest", "full"), "pii-spans")
    text = F.coalesce(col(docs, "text"), F.lit(""))
    rows = docs.select(col(docs, "doc_id").alias("doc_id"), text.alias("text"), _digest(text).alias("digest"))
    met = rows.join(known, "digest", "left").withColumn(
        "base", F.coalesce("base", F.array().cast(f"array<{SPAN}>")))
    # Step by step, each text is masked, searched and cut once, and only where it has such terms.
    masked = met.select("doc_id", "digest", "base", "telling", F.when(
        F.col("telling").isNotNull(), _masked(F.col("text"))).alias("text"))
    cut = masked.select("doc_id", "digest", "base", "telling", F.split("text", TERM, -1).alias("pieces"),
                        F.regexp_extract_all("text", F.lit(TERM), F.lit(0)).alias("runs"))
    return cut.select("doc_id", "digest", "base", _term_spans().alias("found"))


#: Code points of a block of text, so that a span is cut from its block and not from the start of the text.
CUT = 2048


def _between(blocks: Column, start: Column, end: Column) -> Column:
    """Code points [start, end) of the text that ``blocks`` of ``CUT`` code points make."""
    first, last = F.floor(start / CUT).cast("int"), F.floor(end / CUT).cast("int")

    def block(k: Column) -> Column:
        return F.coalesce(F.get(blocks, k), F.lit(""))

    inner = F.array_join(F.slice(blocks, first + 2, F.greatest(last - first - 1, F.lit(0))), "")
    return F.when(end <= start, F.lit("")).when(
        first == last, block(first).substr(start - first * CUT + 1, end - start)).otherwise(F.concat(
            block(first).substr(start - first * CUT + 1, F.lit(CUT)), inner, block(last).substr(F.lit(1), end - last * CUT)))


def rewrite(text: Column, base: Column, found: Column) -> Column:
    """``text`` with its spans replaced; of spans that overlap, the union by the label of the first."""
    spans = F.array_sort(F.concat(
        F.transform(base, lambda b: F.struct(
            b.start.alias("start"), b.end.alias("end"), F.concat(F.lit("<"), b.kind, F.lit(">")).alias("label"))),
        F.transform(found, lambda t: F.struct(
            t.start.alias("start"), t.end.alias("end"),
            F.when(t.disclosure >= REMOVE, F.lit("<removed>")).otherwise(F.lit("*")).alias("label")))))

    def replaced(known: Column) -> Column:
        blocks, own = known["blocks"], known["spans"]
        # Where the text that is done ends before each span.
        done = prefixes(F.transform(own, lambda s: s["end"]), lambda a, b: F.greatest(a, b), F.lit(0))
        pieces = F.zip_with(own, done, lambda s, at: F.when(s.start >= at, F.concat(
            _between(blocks, at, s.start),
            F.when(s.label == "*", F.concat(_between(blocks, s.start, s.start + 1), s.label)).otherwise(s.label))))
        rest = _between(blocks, F.array_max(F.transform(own, lambda s: s["end"])), known["size"])
        return F.concat(F.array_join(F.filter(pieces, lambda p: p.isNotNull()), ""), rest)

    known = F.struct(F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CUT}}}"), F.lit(0)).alias("blocks"), spans.alias("spans"),
                     F.length(text).alias("size"))
    return F.when(F.size(base) + F.size(found) > 0, bound(known, replaced)).otherwise(text)


def sanitise(docs: DataFrame) -> DataFrame:
    """``docs`` with a further column ``sanitised`` (another name if that one is taken)."""
    name, key, spans = free_name(docs, "sanitised"), free_name(docs, "digest"), free_name(docs, "spans")
    found = find(docs).groupBy("digest").agg(F.first(F.struct("base", "found")).alias(spans)).withColumnRenamed("digest", key)
    text = F.coalesce(col(docs, "text"), F.lit(""))
    joined = docs.withColumn(key, _digest(text)).join(materialise(found, "pii-rewrite"), key, "left")
    clean = rewrite(F.coalesce(F.col("text"), F.lit("")), F.col(f"{spans}.base"), F.col(f"{spans}.found"))
    return joined.withColumn(name, clean).select(*[F.col(f"`{c}`") for c in docs.columns], name)


def _written(spans: Column, kind: Column | None = None) -> Column:
    return F.transform(spans, lambda s: F.concat_ws(
        ":", s.kind if kind is None else kind, s.start.cast("string"), s.end.cast("string")))


def _of_kind(spans: Column, kind: str) -> Column:
    return F.filter(spans, lambda s: s.kind == kind)


def op2_pii_sanitise(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find(read_table(spark, sf_dir, "documents"))
    counts = [F.size(_of_kind(F.col("base"), k)).cast("bigint").alias(f"n_{k}") for k in KINDS]
    base, terms = _written(F.col("base")), _written(F.col("found"), F.lit("term"))
    return found.select("doc_id", *counts, F.sha2(F.array_join(base, ",").cast("binary"), 256).alias("base_sha256"),
                        F.array_join(F.concat(base, terms), ",").alias("spans"), F.size("found").alias("n_term"))


QUERIES = {"op2_pii_sanitise": op2_pii_sanitise}
ORACLE_SQL: dict[str, str] = {}
