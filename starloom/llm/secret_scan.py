"""Secret scans: patterns of known forms, and a randomness test battery for unknown ones. Built-in functions only.

Base spans are assignments, access keys and long hexadecimal strings. Beyond these, every run of 20 or more characters
of an encoding alphabet is a candidate, and so is every piece of it of 20 or more characters between + and /, between
- and _, or between any of these signs, as keys may be glued to paths and prefixes. A candidate's encoding (hexadecimal of
one or both cases, base 32, base 64, or all 66 symbols) is inferred from the characters it uses. The battery asks whether it looks drawn at random from that alphabet:

- chi-squared uniformity over the alphabet, as a normal deviate (Wilson and Hilferty);
- the number of runs of symbols in the lower and upper half of the alphabet;
- the serial correlation of neighbouring symbols.

A candidate that deviates by more than ``deviate`` in one of them is not random. For the others the null hypothesis is
"ordinary text": lower-case letters, capitals, digits and signs as often as in all documents. The ratio of the likelihoods (uniform alphabet to ordinary) has mean 1 under it, so its inverse is a valid p-value that shrinks
with length. Candidates are accepted by the Benjamini-Hochberg rule at rate ``rate`` within each band of lengths; p-values
are counted in steps of a tenth of a decade, rounded upwards, so the rule needs only a small table of counts. Runs and
pieces count as tests of their own; of accepted ones only those within no other are reported.

Defined results: a null text is empty and has no spans; repeated rows give equal rows; candidates that overlap a base
span are not reported again; an empty table gives an empty result; only key and text are read.
"""

from __future__ import annotations

from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.spans import matches, outside, settled, spans

#: Fixed patterns of the base forms.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"(?<![0-9a-f])[0-9a-f]{32,}"
CANDIDATE = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}={0,2}"
#: Pieces of a candidate between + and /, between - and _, and between all four signs.
PIECES = tuple(f"(?<![{c}])[{c}]{{20,}}={{0,2}}" for c in ("A-Za-z0-9_-", "A-Za-z0-9+/", "A-Za-z0-9"))
KINDS = ("assign", "access", "hex")
DIGITS, UPPER, LOWER = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: name, what all characters must be, the alphabet in order.
ENCODINGS = (
    ("hex", r"^[0-9a-f]+$", DIGITS + LOWER[:6]),
    ("hexupper", r"^[0-9A-F]+$", DIGITS + UPPER[:6]),
    ("hexmixed", r"^[0-9a-fA-F]+$", DIGITS + LOWER[:6]),
    ("base32", r"^[A-Z2-7]+$", UPPER + DIGITS[2:8]),
    ("base64", r"^[A-Za-z0-9+/]+$", UPPER + LOWER + DIGITS + "+/"),
    ("base64url", r"^[A-Za-z0-9_-]+$", UPPER + LOWER + DIGITS + "-_"),
    ("signs", r"^[A-Za-z0-9+/_-]+$", UPPER + LOWER + DIGITS + "+/-_"),
)
SYMBOLS = UPPER + LOWER + DIGITS + "+/-_"
#: Classes of symbols as a pattern and one by one.
CLASSES = (("a-z", LOWER), ("A-Z", UPPER), ("0-9", DIGITS), ("+/_-", "+/_-"))
STEPS = 3000  # p-values down to 10^-300


def base_spans(text: Column) -> Column:
    has_sign = text.contains("=") | text.contains(":")
    none = F.array().cast("array<struct<match: string, start: int, end: int>>")
    assign = F.when(has_sign, F.filter(matches(text, ASSIGN), lambda m: F.length(F.regexp_extract(m["match"], ASSIGN, 1)) >= 8)).otherwise(none)
    access = F.when(text.contains("AKIA"), F.filter(matches(text, ACCESS), lambda m: m["end"] - m["start"] >= 16)).otherwise(none)
    return F.concat(*(spans(found, i, kind) for i, (found, kind) in enumerate(((assign, "assign"), (access, "access"), (matches(text, HEX), "hex")))))


def tested(token: Column, deviate: float) -> Column:
    """(alphabet size, whether the battery finds nothing against randomness) of a token without padding; size 0: no encoding."""
    result = F.struct(F.lit(0).alias("size"), F.lit(False).alias("random"))
    for name, form, alphabet in reversed(ENCODINGS):
        # Hexadecimal of both cases is uniform without case; no symbol is rarer than one in 32, a bound that keeps p-values valid.
        mixed = name == "hexmixed"
        random = battery(F.lower(token) if mixed else token, alphabet, deviate)
        result = F.when(token.rlike(form), F.struct(F.lit(len(alphabet) * (2 if mixed else 1)).alias("size"), random.alias("random"))).otherwise(result)
    return result


def battery(token: Column, alphabet: str, deviate: float) -> Column:
    size, n = len(alphabet), F.length(token).cast("double")
    codes = F.transform(F.split(token, ""), lambda c: F.instr(F.lit(alphabet), c).cast("double") - 1)
    squares = F.aggregate(F.transform(F.split(F.lit(alphabet), ""), lambda c: F.length(token) - F.length(F.replace(token, c, F.lit("")))),
                          F.lit(0.0), lambda s, x: s + x.cast("double") * x)
    chi, free = squares * size / n - n, size - 1
    uniform = (F.pow(F.greatest(chi, F.lit(0.0)) / free, F.lit(1 / 3)) - (1 - 2 / (9 * free))) / (2 / (9 * free)) ** 0.5

    def walk(acc: Column, x: Column) -> Column:
        centred, half = (x - (size - 1) / 2) / size, (x * 2 >= size).cast("double")
        return F.struct((acc["runs"] + F.when(half == acc["half"], 0.0).otherwise(1.0)).alias("runs"), half.alias("half"), centred.alias("last"),
                        (acc["pairs"] + centred * acc["last"]).alias("pairs"))

    start = F.struct(F.lit(0.0).alias("runs"), F.lit(-1.0).alias("half"), F.lit(0.0).alias("last"), F.lit(0.0).alias("pairs"))
    walked = F.aggregate(codes, start, walk)
    variance = (1 - 1 / size**2) / 12  # of a uniform symbol after centring and scaling
    judged = F.transform(F.array(walked), lambda w: (F.abs(w["runs"] - (n + 1) / 2) <= deviate * F.sqrt(n - 1) / 2)
                         & (F.abs(w["pairs"]) <= deviate * variance * F.sqrt(n - 1)))
    return (uniform <= deviate) & judged[0]


def candidates(text: Column, base: Column, deviate: float) -> Column:
    """Candidates outside base spans, runs and their pieces: start, end, token, alphabet size, random."""
    found = F.filter(F.array_distinct(F.concat(*(matches(text, p) for p in (CANDIDATE, *PIECES)))), lambda m: outside(m["start"], m["end"], base))
    bare = F.transform(found, lambda m: F.struct(m["start"].alias("start"), m["end"].alias("end"), F.rtrim(m["match"], F.lit("=")).alias("token")))
    return F.transform(bare, lambda m: F.struct(m["start"], m["end"], m["token"], tested(m["token"], deviate).alias("test")))


def band(length: Column) -> Column:
    """Bands of lengths: 20-29, 30-39, 40-59, 60-99, 100 and more."""
    return F.when(length < 30, 0).when(length < 40, 1).when(length < 60, 2).when(length < 100, 3).otherwise(4)


def scan(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", rate: float = 0.01, deviate: float = 3.5) -> DataFrame:
    """One row per document: key, base (spans) and found (base and random spans)."""
    return annotate(docs.select(F.col(id_col).alias("c0"), F.col(text_col).alias("c1")), "c1", rate, deviate).select(F.col("c0").alias(id_col), "base", "found")


def annotate(docs: DataFrame, text_col: str, rate: float, deviate: float, keep_text: bool = False) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    narrow = docs if keep_text else docs.drop(text_col)
    kept = [F.col(c) for c in narrow.columns]
    first = docs.select(*kept, text.alias("_text"), base_spans(text).alias("base"))
    used = F.struct(*(F.length(F.regexp_replace("_text", f"[^{c}]+", "")).cast("long").alias(f"n{i}") for i, (c, _) in enumerate(CLASSES)))
    rows = settled(first.select(*kept, "base", candidates(F.col("_text"), F.col("base"), deviate).alias("tokens"), used.alias("used")), "secrets")
    accepted = thresholds(rows, rate)
    hits = F.filter("tokens", lambda t: t["test"]["random"] & accepted(t))
    wider = lambda o, t: (o["start"] <= t["start"]) & (o["end"] >= t["end"]) & (o["end"] - o["start"] > t["end"] - t["start"])
    found = F.transform(F.array(hits), lambda own: F.filter(own, lambda t: ~F.exists(own, lambda o: wider(o, t))))[0]
    return rows.select(*kept, "base", F.array_sort(F.concat("base", spans(found, len(KINDS), "random"))).alias("found"))


def thresholds(rows: DataFrame, rate: float):
    """The condition under which a random-looking token is a discovery, from counts over all documents."""
    tokens = rows.where(F.size("tokens") > 0).select(F.explode("tokens").alias("t")).select("t.token", "t.test")
    used = rows.agg(*(F.coalesce(F.sum(f"used.n{i}"), F.lit(0)) for i in range(len(CLASSES)))).first()
    total = sum(used) + len(SYMBOLS)
    costs = F.create_map(*(F.lit(x) for n, (_, symbols) in zip(used, CLASSES) for c in symbols for x in (c, -log((n / len(symbols) + 1) / total))))

    def step(token: Column, size: Column) -> Column:
        """Tenths of decades of the p-value, rounded towards 1."""
        ordinary = F.aggregate(F.split(token, ""), F.lit(0.0), lambda s, c: s + F.coalesce(F.element_at(costs, c), F.lit(0.0)))
        ratio = ordinary - F.length(token) * F.log(size.cast("double"))
        return F.least(F.greatest(F.floor(ratio / log(10) * 10), F.lit(0)), F.lit(STEPS)).cast("int")

    counted = (tokens.where(F.col("test.size") > 0).select(band(F.length("token")).alias("band"), F.col("test.random").alias("random"), step(F.col("token"), F.col("test.size")).alias("step"))
               .groupBy("band", "random", "step").count().collect())  # at most 5 * 2 * STEPS rows
    limit = {}
    for b in range(5):
        own = [r for r in counted if r["band"] == b]
        tests, passed = sum(r["count"] for r in own), 0
        for r in sorted((r for r in own if r["random"]), key=lambda r: -r["step"]):
            passed += r["count"]
            if 10 ** (-r["step"] / 10) * tests <= rate * passed:
                limit[b] = r["step"]

    def accepted(t: Column) -> Column:
        least = F.lit(STEPS + 1)
        for b, value in limit.items():
            least = F.when(band(F.length(t["token"])) == b, value).otherwise(least)
        return step(t["token"], F.greatest(t["test"]["size"], F.lit(1))) >= least

    return accepted


def redact(docs: DataFrame, *, text_col: str = "text", mark: str = "[secret]", rate: float = 0.01, deviate: float = 3.5) -> DataFrame:
    """docs with every secret span replaced by a mark; all rows and columns stay."""
    names = docs.columns
    at = names.index(text_col)
    found = annotate(docs.toDF(*(f"c{i}" for i in range(len(names)))), f"c{at}", rate, deviate, keep_text=True)
    text = F.col(f"c{at}")

    def cut(acc: Column, s: Column) -> Column:
        start = F.greatest(acc["at"], s["start"])
        piece = F.when(s["end"] <= acc["at"], F.lit("")).otherwise(F.concat(F.substring(text, acc["at"] + 1, start - acc["at"]), F.when(s["start"] >= acc["at"], mark).otherwise("")))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.concat(acc["out"], piece).alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    cleaned = F.aggregate("found", start, cut, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))
    return found.select(*(F.when(F.size("found") > 0, cleaned).otherwise(text).alias(c) if i == at else F.col(f"c{i}").alias(c) for i, c in enumerate(names)))
