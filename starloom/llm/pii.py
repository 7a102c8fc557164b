"""Personal data: patterns of known forms, and terms that give them away. Built-in functions only.

Base spans are e-mail addresses, IPv4 addresses, payment cards (Luhn) and telephone numbers. The entities they name are
protected; words near them may disclose them. For each word within ``reach`` code points before or after a base span the
corpus tells how strongly it reveals the kind: of all its occurrences in all documents, the share that stand near such a
span, against that share over all words. Places before spans, after spans and on either side are counted apart, as a word
may have one side or both. A word is disclosing when, for one of the three, at least ``support`` different texts have it
near a span of the kind, its share is at least ``share``, and the gain is at least ``bits`` bits. Every occurrence of a
disclosing word outside base spans becomes a span of kind ``term``, wherever it stands and also in texts without any base
span; ``sanitise`` removes entities and generalises terms.

All counts cover all documents. Word counts are partially aggregated before they are shuffled, so frequent words cost
one row per task; disclosing terms are joined by shuffle or, when measured to be small, by broadcast.

Defined results: a null text is empty and has no spans; repeated rows give equal rows; an empty table gives an empty
result; null keys are kept; only key and text are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.spans import PIECE, SPAN, by_piece, free, let, matches, pieces, placed, settled, spans

KINDS = ("email", "ip", "card", "phone")
#: Fixed patterns. Possessive quantifiers and look-around only save searching; they find the same leftmost matches. The
#: numbers of digits of cards and telephone numbers are part of the pattern, as their matches are maximal runs anyway.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){11,18}(?![\x20-]?[0-9])"
PHONE = r"\+[0-9](?:[\x20().-]*+[0-9]){8,14}(?![\x20().-]*+[0-9])"
PART = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
IP_PARTS = rf"^{PART}\.{PART}\.{PART}\.{PART}$"
WORD = r"[\p{L}\p{M}]{3,}+"


def luhn(card: Column) -> Column:
    """Whether the digits of a match pass the Luhn check."""
    digits = F.transform(F.split(F.reverse(F.regexp_replace(card, "[^0-9]", "")), ""), lambda c: c.cast("int"))
    worth = F.transform(digits, lambda d, i: F.when(i % 2 == 0, d).when(d < 5, d * 2).otherwise(d * 2 - 9))
    return F.aggregate(worth, F.lit(0), lambda s, d: s + d) % 10 == 0


def base_spans(text: Column) -> Column:
    none = F.array().cast("array<struct<match: string, start: int, end: int>>")
    found = (
        F.when(text.contains("@"), matches(text, EMAIL)).otherwise(none),
        F.filter(matches(text, IP), lambda m: m["match"].rlike(IP_PARTS)),
        F.filter(matches(text, CARD), lambda m: luhn(m["match"])),
        F.when(text.contains("+"), matches(text, PHONE)).otherwise(none),
    )
    return F.concat(*(spans(f, i, kind) for i, (f, kind) in enumerate(zip(found, KINDS))))


NEAR = "array<struct<kind: string, side: int, term: string, start: int, end: int>>"


def context(text: Column, base: Column, reach: int) -> Column:
    """Whole words within reach before and after each base span, outside all spans: kind, side, term, start, end.

    Each stands under its side (0 before, 1 after) and under 2 for either side, once for each kind. The words come from the
    pieces of text around a span, and are compared with the spans of those pieces only: work follows the text's length.
    """
    def near(s: Column, cut: Column, parts: Column, size: Column) -> Column:
        first, last = F.greatest(s["start"] - reach, F.lit(0)), F.least(s["end"] + reach, size)

        def words(a: Column, b: Column, side: int) -> Column:
            """Words between two places that go on neither before the first nor after the last place of the reach."""
            p = F.floor(a / PIECE).cast("int")
            local = F.array_join(F.slice(cut, p + 1, F.floor(b / PIECE).cast("int") - p + 1), "")
            whole = F.filter(matches(F.substring(local, a - p * PIECE + 1, b - a), WORD), lambda w: (
                ((a + w["start"] > first) | (first == 0)) & ((a + w["end"] < last) | (last == size)) & free(a + w["start"], a + w["end"], parts)))
            return F.transform(whole, lambda w: F.struct(s["kind"].alias("kind"), F.lit(side).alias("side"), F.lower(w["match"]).alias("term"), (a + w["start"]).alias("start"), (a + w["end"]).alias("end")))

        return let(F.concat(words(first, s["start"], 0), words(s["end"], last, 1)), lambda one: F.concat(one, F.transform(one, lambda w: w.withField("side", F.lit(2)))))

    found = let(F.length(text), lambda size: let(pieces(text), lambda cut: let(by_piece(base, F.size(cut)), lambda parts: F.flatten(
        F.transform(base, lambda s: near(s, cut, parts, size))))))
    return let(F.array_sort(found), lambda x: F.filter(x, lambda w, i: (i == 0) | (w != F.get(x, i - 1))))


def words_of(text: Column) -> Column:
    """All words of a text, in lower case."""
    return F.transform(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), lambda w: F.lower(w))


def occurrences(text: Column, terms: Column, base: Column) -> Column:
    """Spans of the words of a text that are among the terms and outside base spans; only these are gathered."""
    pairs = F.zip_with(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), F.split(text, WORD, -1),
                       lambda m, gap: F.struct(m.alias("m"), F.length(gap).alias("gap"), F.length(m).alias("size")))

    def make(x: Column, start: Column) -> Column:
        return F.when(F.coalesce(F.array_contains(terms, F.lower(x["m"])), F.lit(False)), F.struct(
            start.alias("start"), F.lit(len(KINDS)).alias("rank"), F.lit("term").alias("kind"), (start + x["size"]).alias("end")))

    hits = placed(pairs, F.lit(0), f"array<{SPAN}>", make)
    count = F.greatest(F.ceil(F.length(text) / PIECE).cast("int"), F.lit(1))
    apart = lambda found: let(by_piece(base, count), lambda parts: F.filter(found, lambda s: free(s["start"], s["end"], parts)))
    return let(hits, lambda found: F.when((F.size(found) > 0) & (F.size(base) > 0), apart(found)).otherwise(found))


def scan(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """One row per document: key, base (spans) and found (base and term spans)."""
    return annotate(docs.select(F.col(id_col).alias("c0"), F.col(text_col).alias("c1")), "c1", **how).select(F.col("c0").alias(id_col), "base", "found")


def annotate(docs: DataFrame, text_col: str, *, reach: int = 40, support: int = 5, share: float = 0.5, bits: float = 4.0, keep_text: bool = False) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    kept = [F.col(c) for c in docs.columns if keep_text or c != text_col]
    first = docs.select(*kept, text.alias("_text"), base_spans(text).alias("base"))
    near = F.when(F.size("base") > 0, context(F.col("_text"), F.col("base"), reach)).otherwise(F.array().cast(NEAR))
    rows = settled(first.select(*kept, *([] if keep_text else ["_text"]), "base", near.alias("near"),
                                F.struct(F.xxhash64("_text").alias("a"), F.length("_text").alias("b"), F.crc32("_text").alias("c")).alias("same")), "pii")
    text = text if keep_text else F.col("_text")
    told = settled(disclosing(rows.select(text.alias("text")), rows, support, share, bits).select("term").distinct(), "pii-terms")
    # Rows of equal text share one key and get the same spans. A written table's size is known, so few terms are broadcast.
    words = rows.select("same", F.explode(F.array_distinct(words_of(text))).alias("term"))
    terms = settled(words.join(told, "term", "left_semi").groupBy("same").agg(F.collect_set("term").alias("terms")), "pii-texts")
    more = F.when(F.col("terms").isNotNull(), occurrences(text, F.col("terms"), F.col("base"))).otherwise(F.array().cast(f"array<{SPAN}>"))
    return rows.join(terms, "same", "left").select(*kept, "base", F.array_sort(F.concat("base", more)).alias("found"))


def disclosing(texts: DataFrame, rows: DataFrame, support: int, share: float, bits: float) -> DataFrame:
    """kind, side and term of the words that reveal a kind, with joint and total counts and the gain in bits."""
    near = rows.where(F.size("near") > 0).select("same", F.explode("near").alias("w")).select("same", "w.kind", "w.side", "w.term")
    joint = (near.groupBy("kind", "side", "term", "same").count().groupBy("kind", "side", "term")
             .agg(F.sum("count").alias("joint"), F.count("*").alias("texts")))  # copies of a text support a word once
    by_kind = joint.groupBy("kind", "side").agg(F.sum("joint").alias("all_joint"))  # three rows for each kind
    words = texts.select(F.explode(words_of(F.col("text"))).alias("term")).groupBy("term").count()
    totals = settled(words.select("term", F.col("count").alias("total")), "pii-words")
    corpus = totals.agg(F.sum("total").alias("corpus"))  # one row
    gain = F.log2(F.col("joint") / F.col("total") / (F.col("all_joint") / F.col("corpus")))
    return (joint.where(F.col("texts") >= support).join(totals, "term").join(F.broadcast(by_kind), ["kind", "side"]).join(F.broadcast(corpus))
            .where((F.col("joint") >= F.col("total") * share) & (gain >= bits)).select("kind", "side", "term", "joint", "total", gain.alias("bits")))


def sanitise(docs: DataFrame, *, text_col: str = "text", general: str = "[term]", **how) -> DataFrame:
    """docs with every base span replaced by its kind and every disclosing term by a general word."""
    names = docs.columns
    at = names.index(text_col)
    found = annotate(docs.toDF(*(f"c{i}" for i in range(len(names)))), f"c{at}", keep_text=True, **how)
    text = F.col(f"c{at}")

    def cut(acc: Column, s: Column) -> Column:
        mark = F.when(s["kind"] == "term", F.lit(general)).otherwise(F.concat(F.lit("["), s["kind"], F.lit("]")))
        piece = F.when(s["end"] <= acc["at"], F.lit("")).when(s["start"] < acc["at"], F.lit("")).otherwise(
            F.concat(F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), mark))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.concat(acc["out"], piece).alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    cleaned = F.aggregate("found", start, cut, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))
    return found.select(*(F.when(F.size("found") > 0, cleaned).otherwise(text).alias(c) if i == at else F.col(f"c{i}").alias(c) for i, c in enumerate(names)))
