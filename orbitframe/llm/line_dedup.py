"""Line dedup: equal lines, and lines within an edit distance, by a segment-partition join.

A line (between line feeds, without spaces at its ends) goes if an equal one comes earlier, that is
at a smaller (doc_id, line number).  One of at least `least` code points also goes if one within
EDITS insertions, deletions and substitutions comes earlier.  Lines of white space stay.

Equal lines become one class.  A class's line of length l is split into EDITS + 1 segments, filed
under (l, number, segment).  Each line probes the lengths l from EDITS below its own to its own
with just those substrings that a segment can meet (the multi-match-aware ranges), so two lines
within the distance share a key.  Pairs whose letter counts differ too much are dropped within the
join; the others are verified by a bit-parallel automaton that keeps, for each number of edits, the
band of 2 * EDITS + 1 diagonals in the bits of an integer.

Keys that many lines share are found in a sample of the lines.  Their lines don't become pairs: one
earlier line within the distance is enough, so each asks in a semi join that verifies within its
condition and ends at the first.  The largest keys are dealt to several tasks.

Everything is DataFrame operations.  Defined results: a null text is empty, and has one empty line;
rows that are equal in doc_id and text are one document, whose lines are judged once; rows that
share a doc_id but not the text are in the order of a hash of the text; a row without an id loses
nothing and removes nothing; a long line is whole, at 4 bytes a code point; an empty table gives an
empty one; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orbitframe.functions.columns import once

from ._store import materialise

EDITS = 2
#: Code points of lines that are compared with others that aren't equal.
LEAST = 20
#: Keys that so many lines file or ask for make no pairs; they are looked for in one of SAMPLED lines.
MANY, SAMPLED = 128, 16
#: Lines of one key that one task compares.
CROWD = 4096
#: Letters that are counted, one count in each byte of a signature; the last byte is the length's.
LETTERS = "etnoiar"


BLANK = " \t\r\x0b\x0c"


def lines_of(text: Column) -> Column:
    return F.transform(F.split(text, "\n"), lambda x: F.trim(x))


def with_signatures(rows: DataFrame) -> DataFrame:
    """rows (line, n and others) with sig: counts of LETTERS and n, modulo 256, one in each byte.

    Each letter is looked for in what the ones before have left of the line; a step is a column of
    its own, so that it is worked out once.
    """
    names, left = rows.columns, ["line", *(f"__left{k}" for k in range(len(LETTERS)))]
    for letter, before, after in zip(LETTERS, left, left[1:]):
        rows = rows.withColumn(after, F.replace(F.col(before), F.lit(letter), F.lit("")))
    counts = [F.octet_length(F.col(before)) - F.octet_length(F.col(after)) for before, after in zip(left, left[1:])]
    sig = F.lit(0).cast("long")
    for k, count in enumerate([*counts, F.col("n")]):
        sig = sig.bitwiseOR(F.shiftleft(count.cast("long").bitwiseAND(F.lit(255)), 8 * k))
    return rows.select(*names, sig.alias("sig"))


def byte(sig: Column, k: int) -> Column:
    return F.shiftrightunsigned(sig, 8 * k).bitwiseAND(F.lit(255))


def apart(a: Column, b: Column) -> Column:
    """How much two signatures' counts differ at least: no more than twice the edits between their lines."""
    out = F.lit(0).cast("long")
    for k in range(len(LETTERS)):
        d = F.abs(byte(a, k) - byte(b, k))
        out = out + F.least(d, 256 - d)
    return out


def longer(a: Column, b: Column) -> Column:
    """How much longer b's line is than a's, if it is by under 256, from their signatures."""
    return F.pmod(byte(b, len(LETTERS)) - byte(a, len(LETTERS)), F.lit(256))


def alike(a: Column, b: Column, more: Column) -> Column:
    """Whether the signatures of two lines, b's longer by `more`, leave it open that they are within EDITS edits."""
    # a substitution moves two counts, an insertion one, and as many as the lengths differ by are insertions
    return apart(a, b) <= 2 * EDITS - more


def with_cuts(rows: DataFrame) -> DataFrame:
    """rows (n and others) and where the segments of lines that are 0 to EDITS shorter than n begin, from 0."""
    n = F.col("n")
    cuts = {f"__cut{less}_{i}": F.call_function("div", (n - less) * i, F.lit(EDITS + 1)).cast("int") for less in range(EDITS + 1) for i in range(1, EDITS + 1)}
    return rows.select("*", *[cut.alias(name) for name, cut in cuts.items()])


def cut(less: int, i: int) -> Column:
    """From with_cuts: where segment i begins (or the one before the last segment ends)."""
    if i == 0:
        return F.lit(0)
    return F.col("n") - less if i > EDITS else F.col(f"__cut{less}_{i}")


def key(less: int, i: int, wide: Column, shift: int) -> Column:
    """The key of segment i for lines of length n - less, with what lies there in this line, some places off."""
    begin = cut(less, i)
    return F.xxhash64(F.col("n") - less, F.lit(i), F.substring(wide, (begin + shift) * 4 + 1, (cut(less, i + 1) - begin) * 4))


def index_keys(wide: Column) -> Column:
    return F.array(*[key(0, i, wide, 0) for i in range(EDITS + 1)])


def probe_keys(wide: Column) -> Column:
    """Keys under which a line of length n can meet one that is as long or up to EDITS shorter; first those that it files."""
    own = [(0, i, 0) for i in range(EDITS + 1)]
    asked = [(less, i, shift) for less in range(EDITS + 1) for i in range(EDITS + 1) for shift in range(max(-i, less - (EDITS - i)), min(i, less + (EDITS - i)) + 1)]
    return F.array(*[key(less, i, wide, shift) for less, i, shift in own + [x for x in asked if x not in own]])


def within(a: Column, b: Column) -> Column:
    """Whether two lines are within EDITS edits.

    Bit d + EDITS of row e says that the first i characters of a and the first i + d of b are
    within e edits; a step takes one more character of a.  Steps begin where the lines first
    differ, and do nothing when no bit is left.
    """
    width = 2 * EDITS + 1
    full = F.lit((1 << width) - 1)

    def step(rows, i, s):
        c = F.get(s["x"], i)
        same = F.lit(0)
        for bit in range(width):  # beyond either end there is no character and so no match
            at = i + (bit - EDITS)
            same = same + F.when((at >= 0) & (F.get(s["y"], at) == c), 1 << bit).otherwise(0)

        def moved(e, m, done):
            """Rows e and on, after a step over the matches m; done: the rows before."""
            if e > EDITS:
                return F.struct(*[v.alias(f"r{k}") for k, v in enumerate(done)])
            new = rows[f"r{e}"].bitwiseAND(m)
            if e:
                below = rows[f"r{e - 1}"]  # substitution, deletion, then insertion
                new = new.bitwiseOR(below).bitwiseOR(F.shiftright(below, 1)).bitwiseOR(F.shiftleft(done[-1], 1)).bitwiseAND(full)
            return once(new, lambda v: moved(e + 1, m, [*done, v]))

        return F.when(rows[f"r{EDITS}"] == 0, rows).otherwise(once(same, lambda m: moved(0, m, [])))

    first = F.struct(*[F.lit(sum(1 << (EDITS + d) for d in range(e + 1))).alias(f"r{e}") for e in range(EDITS + 1)])

    def verdict(s):
        gap = F.size(s["y"]) - F.size(s["x"])
        differs = F.array_position(F.zip_with(s["x"], s["y"], lambda c, d: c.eqNullSafe(d)), False).cast("int")  # from 1; 0: nowhere
        left = F.when((differs > 0) & (differs <= F.size(s["x"])), F.sequence(differs - 1, F.size(s["x"]) - 1)).otherwise(F.array().cast("array<int>"))
        last = F.aggregate(left, first, lambda rows, i: step(rows, i, s))[f"r{EDITS}"]
        wanted = F.get(F.array(*[F.lit(1 << bit) for bit in range(width)]), gap + EDITS)  # null: too unlike in length
        return F.coalesce(last.bitwiseAND(wanted) > 0, F.lit(False))

    return once(F.struct(F.split(a, "").alias("x"), F.split(b, "").alias("y")), verdict)


def crowded(classes: DataFrame) -> list[tuple[int, int, int]]:
    """Keys that lines of classes (id, line, n and cuts) file and MANY or so ask for: at most 10,000, the largest.

    With each, the length that it is for, and among how many tasks to deal its lines.
    """
    some = classes.filter(F.pmod(F.xxhash64("id"), F.lit(SAMPLED)) == 0)
    asked = some.select("n", F.posexplode(once(F.encode("line", "UTF-32"), probe_keys)).alias("at", "key"))
    own = F.col("at") <= EDITS  # a line asks for all keys that it files
    found = asked.groupBy("key").agg(F.count_if(own).alias("filed"), F.min(F.when(own, F.col("n"))).alias("n"), F.count("*").alias("asked"))
    found = found.filter((F.col("filed") > 0) & (F.col("asked") >= MANY // SAMPLED))
    large = found.orderBy(F.desc(F.col("filed") * F.col("asked")), "key").limit(10_000)
    return [(r.key, r.n, -(-r.filed * SAMPLED // CROWD)) for r in large.collect()]


def near_in_crowds(classes: DataFrame, large: list[tuple[int, int, int]]) -> DataFrame:
    """Of classes (id, first, line, n, sig and cuts), the ids that have an earlier line within the distance under one of the keys `large`."""
    lengths = sorted({n + more for _, n, _ in large for more in range(EDITS + 1)})
    ways = F.broadcast(classes.sparkSession.createDataFrame([(k, w) for k, _, w in large], "key long, ways int"))
    asked = classes.filter(F.col("n").isin(lengths)).select("id", "first", "line", "sig", F.posexplode(once(F.encode("line", "UTF-32"), probe_keys)).alias("at", "key"))
    # all lines are read once for the four sides below
    asked = materialise(asked.join(ways, "key"), "crowded")

    def side(name: str, rows: DataFrame, way: Column) -> DataFrame:
        return rows.select(*[F.col(c).alias(f"{c}_{name}") for c in ("id", "first", "line", "sig")], "key", way.alias("way"))

    index = side("a", asked.filter(F.col("at") <= EDITS), F.pmod(F.xxhash64("id"), "ways").cast("int"))
    probe = side("b", asked, F.explode(F.sequence(F.lit(0), F.col("ways") - 1)))
    more = longer(F.col("sig_a"), F.col("sig_b"))
    # the built-in distance, which is quick to give up, leaves few pairs to the automaton
    close = alike(F.col("sig_a"), F.col("sig_b"), more) & (F.levenshtein("line_a", "line_b", EDITS) >= 0) & within(F.col("line_a"), F.col("line_b"))
    same = (index["key"] == probe["key"]) & (index["way"] == probe["way"])
    late = probe.join(index, same & (F.col("first_a") < F.col("first_b")) & close, "left_semi").select(F.col("id_b").alias("id"))
    # lines of one length meet either way round: above is enough for them
    other = index.join(probe, same & (more > 0) & (F.col("first_b") < F.col("first_a")) & close, "left_semi").select(F.col("id_a").alias("id"))
    return late.unionByName(other)


def near_classes(classes: DataFrame) -> DataFrame:
    """Of classes (id, first, line, n, sig), the ids that have an earlier line within the distance."""
    # four bytes a code point: parts of a line are then found without counting from its beginning
    wide, classes = F.encode("line", "UTF-32"), with_cuts(classes)
    index = classes.select(F.col("id").alias("a"), F.col("sig").alias("sig_a"), F.explode(once(wide, index_keys)).alias("key"))
    probe = classes.select(F.col("id").alias("b"), F.col("sig").alias("sig_b"), F.explode(once(wide, probe_keys)).alias("key"))
    large = crowded(classes)
    if large:
        plain = F.expr(f"key not in ({', '.join(f'{k}L' for k, _, _ in large)})")
        index, probe = index.filter(plain), probe.filter(plain)
    # a key holds the length that it is for, so b's line is as long as a's or up to EDITS longer
    more = longer(F.col("sig_a"), F.col("sig_b"))
    # lines of one length meet either way round: one way is enough
    ahead = (more > 0) | (F.col("a") < F.col("b"))
    met = index.join(probe, (index["key"] == probe["key"]) & ahead & alike(F.col("sig_a"), F.col("sig_b"), more))
    pairs = materialise(met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "pairs")
    # the lines that are in a pair, so that all others travel once and not for each side
    asked = pairs.select(F.col("a").alias("id")).distinct().unionByName(pairs.select(F.col("b").alias("id")).distinct())
    told = materialise(classes.select("id", "line", "first").join(asked.hint("merge"), "id", "left_semi"), "compared")
    one = told.select(F.col("id").alias("a"), F.col("line").alias("line_a"), F.col("first").alias("first_a"))
    two = told.select(F.col("id").alias("b"), F.col("line").alias("line_b"), F.col("first").alias("first_b"))
    close = pairs.join(one, "a").join(two, "b").filter(within(F.col("line_a"), F.col("line_b")))
    near = close.select(F.when(F.col("first_a") < F.col("first_b"), F.col("b")).otherwise(F.col("a")).alias("id"))
    return (near.unionByName(near_in_crowds(classes, large)) if large else near).distinct()


def place() -> Column:
    """Where a line is, as one number in the order of doc_id, mark (its lowest 30 bits) and line number.

    A number, as a struct would turn the aggregation over lines into one that sorts them.
    """
    mark = F.col("mark").bitwiseAND(F.lit((1 << 30) - 1))
    low = F.shiftleft(mark, 32).bitwiseOR(F.col("pos").cast("long"))
    return (F.col("doc_id").cast("decimal(19,0)") * F.lit(1 << 62).cast("decimal(19,0)") + low).cast("decimal(38,0)")


def not_blank(line: Column) -> Column:
    """Whether a line without spaces at its ends has more than white space; only one that begins with such is looked through."""
    begins = F.octet_length(F.trim(F.substring(line, 1, 1), F.lit(BLANK))) > 0
    return begins | (F.octet_length(F.trim(line, F.lit(BLANK))) > 0)


def removed_lines(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """doc_id, mark (a hash of the text) and gone, the numbers (from 0) of the lines that go, ascending."""
    # the mark is a column of its own first: beside the lines it would be worked out for each of them
    rows = docs.select("doc_id", F.xxhash64("text").alias("mark"), lines_of(F.col("text")).alias("lines"))
    rows = rows.select("doc_id", "mark", F.posexplode("lines").alias("pos", "line"))
    full = rows.filter(not_blank(F.col("line")))
    # a line that was found once is no repeated one; which of several go is told by their places
    classes = full.groupBy("line").agg(F.min(place()).alias("first"), F.count("*").alias("found"))
    classes = with_signatures(classes.select("line", "first", (F.col("found") > 1).alias("repeated"), F.length("line").alias("n")))
    classes = materialise(classes.withColumn("id", F.monotonically_increasing_id()), "lines")
    near = materialise(near_classes(classes.filter(F.col("n") >= least)).withColumn("near", F.lit(True)), "near")
    hashes = [F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2")]
    told = classes.select("id", *hashes, "first", "repeated").join(near, "id", "left").filter("repeated or near").select("h1", "h2", "first", F.coalesce("near", F.lit(False)).alias("near"))
    gone = full.select("doc_id", "mark", "pos", *hashes).join(told, ["h1", "h2"]).filter(F.col("near") | (place() != F.col("first")))
    return gone.groupBy("doc_id", "mark").agg(F.sort_array(F.collect_set("pos")).alias("gone"))


def without(lines: Column, gone: Column) -> Column:
    """The lines whose numbers are not in gone, as the stretches between those."""
    begins = F.concat(F.array(F.lit(0)), F.transform(gone, lambda g: g + 1))

    def stretches(lines):
        ends = F.concat(gone, F.array(F.size(lines)))
        return F.flatten(F.zip_with(begins, ends, lambda b, e: F.slice(lines, b + 1, e - b)))

    return once(lines, stretches)


def drop_lines(docs: DataFrame, extra: tuple[str, ...] = (), least: int = LEAST) -> DataFrame:
    """doc_id, n_lines, n_removed and kept (the text without the lines that go) for each row of docs; and its columns `extra`."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), *[F.col(c).alias(f"__{c}") for c in extra])
    gone = removed_lines(rows.select("doc_id", "text").filter("doc_id is not null"), least)
    rows = rows.withColumn("mark", F.xxhash64("text")).join(gone, ["doc_id", "mark"], "left")
    lines, whole = F.split("text", "\n"), F.col("gone").isNull()
    return rows.select(
        "doc_id", F.size(lines).cast("long").alias("n_lines"), F.when(whole, 0).otherwise(F.size("gone")).cast("long").alias("n_removed"),
        F.when(whole, F.col("text")).otherwise(F.array_join(without(lines, F.col("gone")), "\n")).alias("kept"), *[F.col(f"__{c}").alias(c) for c in extra],
    )
