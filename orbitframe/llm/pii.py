"""Personal data: candidates, boosted trees and calibrated thresholds, all as column expressions.

Base generators (email, ip, card, phone) find spans that are always kept if their own checks hold.
Further generators with high recall propose more, which may overlap: local phone numbers, social
security numbers, spelled-out email addresses, bank accounts, long internet addresses, dates of
birth, and secrets, of any length.  Boosted trees look at each one's format and the characters
around it; those whose calibrated probability reaches their kind's threshold are kept, unless they
overlap a base span or an earlier kept one.

The tables have no labels for this.  The trees are fitted on the driver on `TRAINING` made-up spans,
drawn from fixed seeds, that stand in surroundings taken from the documents themselves (at most
CONTEXTS of them), and on real negatives: candidates from about SAMPLE_DOCS documents that are plain
runs of letters, at most NEGATIVES of them.  Three fifths of these spans grow the trees, one fifth
calibrates them, and the last one gives thresholds: the least at which 95 of 100 of a kind are right.

Places are code points, the end exclusive.  Defined results: a null text is empty; a text without
candidates has counts of 0, the hash of an empty string and an empty list; repeated rows are looked
at one by one; rows with a null id are too; a long text is whole, one task's; an empty table gives
an empty one; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import random
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orbitframe.functions.columns import once

from . import boosting
from ._text import low

# The patterns begin where a run of their characters does and never give back what they took:
# the same matches as their plain forms, in time proportional to the text.
LOCAL = "A-Za-z0-9._%+-"
BASE = {
    "email": rf"(?:\G|(?<![{LOCAL}]))[{LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?<![0-9])[0-9]++(?:[\x20-][0-9]++)*+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
MORE = {
    "local_phone": r"(?<![0-9+])(?:\([0-9]{3}\)\x20?|[0-9]{3}[.\x20-])[0-9]{3}[.\x20-][0-9]{4}(?![0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "spelled_email": r"(?<![A-Za-z0-9_.])[A-Za-z0-9_.]++\x20?(?:\[at\]|\(at\)|\{at\}|(?<=\x20)at\x20)\x20?[A-Za-z0-9-]++(?:\x20?(?:\[dot\]|\(dot\)|\{dot\}|(?<=\x20)dot\x20|\.)\x20?[A-Za-z0-9-]++)++",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}+(?:\x20?[A-Z0-9]{1,3})?+(?![A-Za-z0-9])",
    "ipv6": r"(?<![0-9A-Za-z:.])(?=[0-9A-Fa-f]*+:[0-9A-Fa-f]*+:)[0-9A-Fa-f:]{6,}+(?![0-9A-Za-z:.])",
    "birth": r"(?<![0-9./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}[./][0-9]{1,2}[./][0-9]{4})(?![0-9/-])",
    "secret": r"(?<![A-Za-z0-9_/+-])(?=[0-9_/+-]*+[A-Za-z])[A-Za-z0-9_/+-]{16,}+",
}
#: Characters without which a kind has no match.
NEEDS = {"email": "@", "phone": "+", "spelled_email": "at", "ipv6": ":"}
KINDS = (*BASE, *MORE)
AROUND = 32
TRAINING, CONTEXTS, SAMPLE_DOCS, NEGATIVES = 6000, 1000, 2000, 500
FEATURES = ("kind", "size", "digits", "letters", "upper", "distinct", "marks", "cue", "near", "assigned", "joined", "switches", "vowels", "brackets", "dot", "colons", "checked")


def proposals(text: Column, kind: str, pattern: str) -> Column:
    """An array of (kind, k, match, gap, before, after): the matches in order; gap is the size of the text since the last one."""
    guard = F.contains(text, F.lit(NEEDS[kind])) if kind in NEEDS else F.lit(True) if kind == "secret" else F.regexp_like(text, F.lit("[0-9]"))
    found = F.when(guard, F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))

    def one(m, i, gaps):
        before, after = F.get(gaps, i), F.get(gaps, i + 1)
        return F.struct(
            F.lit(kind).alias("kind"), i.alias("k"), m.alias("match"), F.length(before).alias("gap"),
            F.right(before, F.lit(AROUND)).alias("before"), F.left(after, F.lit(AROUND)).alias("after"),
        )

    def listed(matches):
        gaps = F.when(F.size(matches) > 0, F.split(text, pattern, -1))
        return once(gaps, lambda g: F.transform(matches, lambda m, i: one(m, i, g)))

    return F.coalesce(once(found, listed), F.array().cast("array<struct<kind:string,k:int,match:string,gap:int,before:string,after:string>>"))


def luhn(digits: Column) -> Column:
    def worth(c, i):
        v = c.cast("int")
        return F.when(i % 2 == 1, F.when(v > 4, 2 * v - 9).otherwise(2 * v)).otherwise(v)

    return F.aggregate(F.transform(F.split(F.reverse(digits), ""), worth), F.lit(0), lambda a, b: a + F.coalesce(b, F.lit(0))) % 10 == 0


def holds(kind: Column, match: Column) -> Column:
    """Whether a base match passes its kind's check."""
    digits = F.regexp_replace(match, "[^0-9]", "")
    n = F.length(digits)
    small = F.forall(F.split(match, r"\."), lambda p: F.coalesce(F.try_to_number(F.right(F.concat(F.lit("00"), F.regexp_replace(p, "^0+", "")), F.lit(3)), F.lit("999")) <= 255, F.lit(False)) & (F.length(F.regexp_replace(p, "^0+", "")) <= 3))
    return (
        F.when(kind == "email", True).when(kind == "ip", small).when(kind == "card", F.when(n.between(12, 19), luhn(digits)).otherwise(False))
        .when(kind == "phone", n.between(9, 15)).otherwise(False)
    )


def feature_columns(kind: Column, match: Column, before: Column, after: Column) -> dict[str, Column]:
    size = F.length(match)

    def count(pattern: str) -> Column:
        return size - F.length(F.regexp_replace(match, pattern, ""))

    words = F.lit(r"pass|pwd|token|key|secret|ssn|social|phone|call|tel|mobile|mail|contact|auth|bearer|iban|account|konto|born|birth|dob|host|addr")
    switches = F.size(F.regexp_extract_all(match, F.lit("[0-9]+|[A-Z]+|[a-z]+"), F.lit(0)))
    return {
        "kind": F.coalesce(F.array_position(F.array(*[F.lit(k) for k in MORE]), kind).cast("double"), F.lit(0.0)),
        "size": size.cast("double"),
        "digits": count("[0-9]") / size,
        "letters": count("[A-Za-z]") / size,
        "upper": count("[A-Z]") / size,
        "distinct": F.size(F.array_distinct(F.split(match, ""))) / size,
        "marks": count("[A-Za-z0-9]").cast("double") * -1 + size,
        "cue": F.regexp_like(F.lower(before), words).cast("double"),
        "near": F.regexp_like(F.lower(F.right(before, F.lit(12))), words).cast("double"),
        "assigned": F.regexp_like(before, F.lit(r"[=:]\s*[\"']?$")).cast("double"),
        "joined": (F.regexp_like(before, F.lit(r"[^\s\"'=:(]$")) | F.regexp_like(after, F.lit(r"^[^\s\"',.;:!?)]"))).cast("double"),
        "switches": switches / size,
        "vowels": count("[AEIOUaeiou]") / size,
        "brackets": count(r"[\[\](){}]").cast("double"),
        "dot": F.regexp_like(match, F.lit(r"(?i)[^a-z]dot[^a-z]")).cast("double"),
        "colons": count(":").cast("double"),
        "checked": F.when(kind == "iban", checked(match)).otherwise(F.lit(False)).cast("double"),
    }


def checked(match: Column) -> Column:
    """Whether a bank account's check digits are right."""
    plain = F.replace(match, F.lit(" "), F.lit(""))
    turned = F.concat(F.substr(plain, F.lit(5)), F.left(plain, F.lit(4)))
    value = lambda c: F.when(F.ascii(c) > 57, F.ascii(c) - 55).otherwise(F.ascii(c) - 48)
    digits = F.filter(F.split(turned, ""), lambda c: c != "")
    return F.aggregate(digits, F.lit(0), lambda a, c: (a * F.when(value(c) > 9, 100).otherwise(10) + value(c)) % 97) == 1


def made_up(rng: random.Random, around: list[str]) -> tuple[str, str, str, str, int]:
    """A span of one of the further kinds, with surroundings, and whether it is personal or secret."""
    word = lambda: "".join(rng.choice(["th", "er", "an", "en", "de", "la", "on", "re", "st", "ou", "in"]) for _ in range(rng.randint(1, 4)))
    some = lambda chars, n: "".join(rng.choice(chars) for _ in range(n))
    digit, lower, hexa = "0123456789", "abcdefghijklmnopqrstuvwxyz", "0123456789abcdef"
    both = lower + lower.upper() + digit
    kind, good = rng.choice(list(MORE)), rng.randint(0, 1)
    before, after = f"{word()} {word()} ", f" {word()} {word()}."
    if len(around) >= 20:
        text = rng.choice(around)
        cut = rng.randint(0, len(text))
        before, after = text[:cut].rstrip() + " ", " " + text[cut:].lstrip()
    if rng.random() < 0.3:  # a telling word that belongs to something else
        before = rng.choice(["call", "token", "host", "IBAN", "born", "SSN", "account"]) + " " + before[-rng.randint(14, 20) :].rjust(14)
    if kind == "local_phone":
        s = rng.choice([" ", "-", "."])
        match = f"{some(digit, 3)}{s}{some(digit, 3)}{s}{some(digit, 4)}" if rng.random() < 0.6 else f"({some(digit, 3)}) {some(digit, 3)}-{some(digit, 4)}"
        if good:
            before += rng.choice(["phone ", "call ", "tel: ", "mobile: ", "contact: "]) if rng.random() < 0.8 else ""
        else:
            before = rng.choice(["pages ", "rows ", "in ", "sum ", "x"]) + some(digit, 3) + rng.choice([" ", "-", "."])
    elif kind == "ssn":
        match = f"{some(digit, 3)}-{some(digit, 2)}-{some(digit, 4)}"
        before += rng.choice(["ssn ", "SSN: ", "social security "]) if good else rng.choice(["part ", "no. ", "item "])
    elif kind == "spelled_email":
        user, host = some(lower, rng.randint(3, 9)), some(lower, rng.randint(3, 9))
        if good:
            a, d = rng.choice([("[at]", "[dot]"), ("(at)", "(dot)"), (" at ", " dot "), (" [at] ", ".")])
            match = f"{user}{a}{host}{d}{rng.choice(['com', 'org', 'net'])}"
        else:
            tail = [word(), *[word().title() for _ in range(rng.randint(1, 3))]]
            match = f"{rng.choice([word(), word().title()])} at {rng.choice(['. ', '. ', '. ', '.']).join(tail)}"
    elif kind == "iban":
        body, land = some(digit, rng.choice([12, 16, 18, 20])), rng.choice(["DE", "FR", "ES", "GB", "NL", "IT"])
        right = 98 - int(body + "".join(str(ord(c) - 55) for c in land) + "00") % 97
        match = f"{land}{(right if good else (right + rng.randint(1, 90)) % 97):02d}{body}"
        if rng.random() < 0.5:
            match = " ".join(match[k : k + 4] for k in range(0, len(match), 4))
        before += rng.choice(["IBAN ", "iban: ", "account ", "", ""]) if good else rng.choice(["part ", "no. ", "", ""])
    elif kind == "ipv6":
        if good:
            groups = [some(hexa, rng.randint(1, 4)) for _ in range(8)]
            match = ":".join(groups) if rng.random() < 0.6 else ":".join(groups[: rng.randint(2, 4)]) + "::" + ":".join(groups[: rng.randint(1, 3)])
            before += rng.choice(["host ", "addr ", "", "", "from "])
        else:
            match = rng.choice([lambda: f"{rng.randint(10, 23)}:{some('012345', 1)}{some(digit, 1)}:{some('012345', 1)}{some(digit, 1)}", lambda: "::::::", lambda: f"{some(digit, 2)}::{some(digit, 2)}", lambda: f"{some(digit, 1)}:{some(digit, 2)}:{some(digit, 2)}"])()
    elif kind == "birth":
        y, m, d = rng.randint(1930, 2015), rng.randint(1, 12), rng.randint(1, 28)
        match = rng.choice([f"{y}-{m:02d}-{d:02d}", f"{d:02d}.{m:02d}.{y}", f"{m}/{d}/{y}"])
        before += rng.choice(["born ", "born on ", "DOB: ", "date of birth ", "birthday: "]) if good else rng.choice(["on ", "since ", "until ", "of ", "", "", "version "])
    elif good:
        match = rng.choice([lambda: "AKIA" + some(lower.upper() + digit, 16), lambda: some(hexa, rng.choice([18, 32, 40, 64])), lambda: some(both, rng.randint(20, 44)), lambda: rng.choice(["ghp_", "sk-", "xoxb-", "glpat-"]) + some(both, 36), lambda: some(both, rng.randint(45, 400))])()
        cue = rng.choice(["password=", 'token = "', "key: ", "api_key=", "secret=", 'token: "', "Bearer ", "", ""])
        before += cue
        after = '"' * cue.endswith('"') + after
    else:
        match = rng.choice([lambda: "".join(word() for _ in range(6))[:60], lambda: "-".join(word() for _ in range(5)), lambda: "_".join(word() for _ in range(5)), lambda: "/".join(word() for _ in range(5)), lambda: "".join(word() for _ in range(6)).upper()[:50], lambda: word() + "-" + some(digit, rng.randint(14, 18)), lambda: word() + some("-_/", 1) * rng.randint(14, 300)])()
        match = match if len(match) >= 16 else match + "erthenstoure"[: 16 - len(match)] * 2
    return kind, match, before[-AROUND:], after[:AROUND], good


@dataclass(frozen=True)
class Model:
    """The trees, each further kind's threshold, and its precision and recall on the spans that gave it."""

    trees: boosting.Trees
    least: dict[str, float]
    quality: dict[str, tuple[float, float]]


def learn(docs: DataFrame, rows: int = TRAINING) -> Model:
    """A model from made-up spans in the documents' surroundings and from their plain runs of letters."""
    spark, size = docs.sparkSession, 2 * AROUND
    texts = docs.filter(F.length("text") > size).select("text", F.xxhash64("text").alias("mark"))
    begin = (F.pmod("mark", F.length("text") - size) + 1).cast("int")
    windows = texts.select("mark", F.substr("text", begin, F.lit(size)).alias("piece")).dropDuplicates(["piece"]).orderBy("mark", "piece").limit(CONTEXTS)
    around = [" ".join(r.piece.split()) for r in windows.collect()]
    n = max(1, docs.count())
    few = texts.filter(F.col("mark") <= F.lit(low(SAMPLE_DOCS / n)))
    plain = few.select(F.explode(proposals(F.col("text"), "secret", MORE["secret"])).alias("c")).select("c.*").filter(F.regexp_like("match", F.lit("^[A-Za-z]?[a-z]+$")))
    plain = plain.select("match", "before", "after").distinct().orderBy(F.xxhash64("match", "before"), "match", "before", "after").limit(NEGATIVES)
    rng = random.Random(17)
    made = [made_up(rng, around) for _ in range(rows)] + [("secret", r.match, r.before, r.after, 0) for r in plain.collect()]
    rng.shuffle(made)
    table = spark.createDataFrame([(i, *m) for i, m in enumerate(made)], "i int, kind string, match string, before string, after string, good int")
    cols = feature_columns(F.col("kind"), F.col("match"), F.col("before"), F.col("after"))
    found = table.select("i", "kind", "good", *[cols[f].cast("double").alias("f_" + f) for f in FEATURES]).orderBy("i").collect()
    x, y, kinds = np.array([r[3:] for r in found], dtype=float), np.array([float(r[2]) for r in found]), np.array([r[1] for r in found])
    fifth = np.arange(len(x)) % 5
    trees = boosting.fit(FEATURES, x, y, grown=fifth < 3, held=fifth == 3)
    p, least, quality = boosting.probability(trees, x), {}, {}
    for kind in MORE:
        own = (fifth == 4) & (kinds == kind)
        cuts = [c / 100 for c in range(30, 100) if (own & (p >= c / 100)).any() and y[own & (p >= c / 100)].mean() >= 0.95]
        least[kind] = cuts[0] if cuts else 0.99
        taken = own & (p >= least[kind])
        quality[kind] = (float(y[taken].mean()) if taken.any() else 0.0, float(y[taken].sum() / max(1.0, y[own].sum())))
    return Model(trees, least, quality)


def spans(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """row, doc_id and, for each candidate, kind, match, start, stop, base (kept by its check), probability, kept.

    A row without candidates appears once, with nulls.
    """
    model = model or learn(docs)
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("row"), text.alias("text"))
    found = [proposals(F.col("text"), kind, p) for kind, p in (BASE | MORE).items()]
    each = rows.select("row", "doc_id", F.explode_outer(F.concat(*found)).alias("c")).select("row", "doc_id", "c.*").repartition("row")
    order = Window.partitionBy("row", "kind").orderBy("k")
    size = F.length("match")
    stop = F.sum((F.col("gap") + size).cast("long")).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    each = each.withColumn("stop", stop).withColumn("start", F.col("stop") - size).withColumn("base", holds(F.col("kind"), F.col("match")))
    further = F.col("kind").isin(*MORE)
    cols = {f: F.col("f_" + f) for f in FEATURES}
    each = each.withColumns({"f_" + f: F.when(further, c.cast("double")) for f, c in feature_columns(F.col("kind"), F.col("match"), F.col("before"), F.col("after")).items()})
    each = each.withColumn("probability", F.when(further, boosting.column(model.trees, cols))).drop(*["f_" + f for f in FEATURES])
    cut = F.create_map(*[x for k, v in model.least.items() for x in (F.lit(k), F.lit(v))])
    each = each.withColumn("likely", F.coalesce(further & (F.col("probability") >= cut[F.col("kind")]), F.lit(False)))
    w = Window.partitionBy("row").orderBy("start", "stop", "kind")
    past, ahead = w.rowsBetween(Window.unboundedPreceding, -1), w.rowsBetween(1, Window.unboundedFollowing)
    firm = F.col("base") | F.col("likely")
    taken = F.coalesce(F.max(F.when(firm, F.col("stop"))).over(past) > F.col("start"), F.lit(False))
    soon = F.coalesce(F.min(F.when(F.col("base"), F.col("start"))).over(ahead) < F.col("stop"), F.lit(False))
    return each.withColumn("kept", F.coalesce(F.col("base") | (F.col("likely") & ~taken & ~soon), F.lit(False)))


def find(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """A row for each row of docs: doc_id, counts of base spans, base_sha256, spans, and counts of the spans kept besides and of all."""
    each = spans(docs, model)
    place = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind"))
    one = F.struct("start", place.alias("place"), F.concat_ws(":", "kind", "start", "stop").alias("said"))

    def listed(which: Column) -> Column:
        return F.array_join(F.transform(F.sort_array(F.collect_list(F.when(which, one))), lambda s: s["said"]), ",")

    counts = [F.count_if(F.col("base") & (F.col("kind") == k)).alias(f"n_{k}") for k in BASE]
    more = [F.count_if(F.col("kept") & (F.col("kind") == k)).alias(f"n_{k}") for k in MORE]
    out = each.groupBy("row", "doc_id").agg(*counts, F.sha2(listed(F.col("base")), 256).alias("base_sha256"), listed(F.col("kept")).alias("spans"), *more, F.count_if("kept").alias("n_spans"))
    return out.drop("row")


def redact(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """doc_id and text with each kept span replaced by its kind in angle brackets (the first, of spans that overlap)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("row"), F.coalesce("text", F.lit("")).alias("text"))
    w = Window.partitionBy("row").orderBy("start", "stop", "kind")
    before = F.max("stop").over(w.rowsBetween(Window.unboundedPreceding, -1))
    each = spans(docs, model).filter("kept").withColumn("reach", F.coalesce(before, F.lit(0))).filter("start >= reach")
    cuts = each.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "reach", "stop", "kind"))).alias("cuts"))
    joined = rows.join(cuts, "row", "left")
    parts = F.transform("cuts", lambda c: F.concat(F.substr("text", (c["reach"] + 1).cast("int"), (c["start"] - c["reach"]).cast("int")), F.lit("<"), c["kind"], F.lit(">")))
    tail = F.substr("text", (F.element_at("cuts", -1)["stop"] + 1).cast("int"))
    return joined.select("doc_id", F.when(F.col("cuts").isNull(), F.col("text")).otherwise(F.concat(F.array_join(parts, ""), tail)).alias("text"))
