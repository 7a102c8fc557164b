"""Spans of long and dense texts, disclosure counts against brute force, and rows kept of groups of near copies."""

import random
import re
import time
from collections import Counter, defaultdict
from math import log2

from pyspark.sql import functions as F

from starloom.llm import jaccard, pii, spans

WORD = re.compile(r"(?:[^\W\d_]|[̀-ͯ]){3,}")


def dense(n, seed=5):
    rng = random.Random(seed)
    words = ["GET", "ok", "user", "naïve", "日本語の", "x", "POST", "0", "🎉", "word" * 90]
    return " ".join(f"{' '.join(rng.choices(words, k=rng.randint(0, 3)))} 10.{rng.randrange(300)}.{i % 256}.{rng.randrange(260)}" for i in range(n))


def brute_context(text, base, reach):
    """Words near base spans as the docstring of context has them."""
    out = set()
    for s in base:
        first, last = max(s["start"] - reach, 0), min(s["end"] + reach, len(text))
        for a, b, side in ((first, s["start"], 0), (s["end"], last, 1)):
            for m in WORD.finditer(text[a:b]):
                start, end = a + m.start(), a + m.end()
                if (start > first or first == 0) and (end < last or last == len(text)) and not any(x["start"] < end and start < x["end"] for x in base):
                    out |= {(s["kind"], k, m.group().lower(), start, end) for k in (side, 2)}
    return out


def test_context_equals_brute_force_over_pieces(spark):
    texts = [dense(n, n) for n in (1, 3, 20, 150)] + ["mail " + "a." * 400 + "1.2.3.4.5.6.7.8@host.example and words after it 10.0.0.1", "10.0.0.1" + " abc" * 100 + " 10.0.0.2abc def"]
    table = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    got = table.select("id", pii.base_spans(F.col("text")).alias("base"), "text").select("id", "base", pii.context(F.col("text"), F.col("base"), 40).alias("near")).collect()
    for r in got:
        near = [tuple(w) for w in r["near"]]
        assert len(near) == len(set(near)) and set(near) == brute_context(texts[r["id"]], r["base"], 40)


def test_matches_in_chunks_equal_regular_expressions(spark):
    texts = [dense(700), "", "ab", "1", "1 " * 128, "x" + "1 " * 129, "1"]
    table = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    for r in table.select("id", spans.matches(F.col("text"), "[0-9]+").alias("m")).collect():
        assert [tuple(m) for m in r["m"]] == [(m.group(), m.start(), m.end()) for m in re.finditer("[0-9]+", texts[r["id"]])]


def test_a_log_of_addresses_takes_time_in_proportion(spark):
    took = {}
    for n in (5_000, 40_000):
        table = spark.createDataFrame([(1, " ".join(f"10.{i % 256}.{i // 256 % 256}.{i % 7} GET" for i in range(n)))], "doc_id long, text string")
        start = time.time()
        row = pii.scan(table).first()
        took[n] = time.time() - start
        assert len(row["base"]) == n
    assert took[40_000] < 60 and took[40_000] < 16 * took[5_000], took


def test_disclosure_counts_and_bits_equal_brute_force(spark):
    rng = random.Random(8)
    words = ["alpha", "beta", "gamma", "delta", "epsilon", "zeta"]
    rows = [(i, " ".join(rng.choices(words, k=6)) + (f" code 10.1.2.{i % 200} mark" if i % 3 else " code") + f" t{i}") for i in range(60)]
    rows += [(100, rows[1][1]), (101, None)]
    table = spark.createDataFrame(rows, "doc_id long, text string").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    near = table.select("text", pii.base_spans(F.col("text")).alias("base")).select("text", "base", pii.context(F.col("text"), F.col("base"), 40).alias("near"))
    frame = near.withColumn("same", F.struct(F.xxhash64("text").alias("a"), F.length("text").alias("b"), F.crc32("text").alias("c")))
    got = {(r["kind"], r["side"], r["term"]): (r["joint"], r["total"], round(r["bits"], 9)) for r in pii.disclosing(table.select("text"), frame, 2, 0.1, -50.0).collect()}
    joint, texts, total = Counter(), defaultdict(set), Counter()
    for r in frame.collect():
        total.update(m.group().lower() for m in WORD.finditer(r["text"]))
        for kind, side, term, *_ in brute_context(r["text"], r["base"], 40):
            joint[kind, side, term] += 1
            texts[kind, side, term].add(r["text"])
    everything = Counter()
    for (kind, side, _), n in joint.items():
        everything[kind, side] += n
    want = {k: (n, total[k[2]], round(log2(n / total[k[2]] / (everything[k[:2]] / total.total())), 9)) for k, n in joint.items() if len(texts[k]) >= 2 and n >= 0.1 * total[k[2]]}
    assert got == want and ("ip", 0, "code") in got


def test_keep_first_keeps_one_row_of_each_group_and_every_other_text(spark):
    text = " ".join(f"w{i}" for i in range(60))
    other = " ".join(f"v{i}" for i in range(60))
    rows = [(1, text), (2, text + " z"), (2, other), (1, text), (1, text), (None, text), (None, "lonely text of its own"), (5, None), (5, None), (6, ""), (3, other), (7, "short one"), (7, "short one")]
    table = spark.createDataFrame([(i, t, "x", "y", "z") for i, t in rows], "doc_id long, text string, component_id string, key string, rank string").repartition(4)
    kept = jaccard.keep_first(table, percent=80, n=5)
    assert kept.columns == table.columns
    assert Counter((r["doc_id"], r["text"]) for r in kept.collect()) == Counter(
        [(1, text), (2, other), (None, "lonely text of its own"), (5, None), (5, None), (6, ""), (7, "short one")])
    assert jaccard.keep_first(table.where("false")).count() == 0
