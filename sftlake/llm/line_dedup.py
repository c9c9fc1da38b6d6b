"""Line deduplication by a segment-partition edit join, in DataFrame operations alone.

A line is what ``\\n`` separates, without white space at its ends. Lines are alike when they are
equal, or when both have at least ``MIN_CHARS`` characters and are within one edit for each
``CHARS_AN_EDIT`` characters of the shorter, ``MAX_EDITS`` at most.
Of each class of alike lines (links followed through) the first line of the corpus stays, by
(doc_id, text, line number); the others go. Blank lines always stay.

Lines fall into length classes, each with its number t of edits. A line of a class has t + 1
segments of one width, the first half of them counted from its start, the others from its end. Of
the t + 1 at most t can be changed, and one that is whole has as many edits before it as segments,
and no more than the segments after it behind it. So a line holds its own segments under (class,
segment number, text), and probes for those of others by its substrings up to i places beside
segment i, where i counts from the nearer end: 18 keys for 5 edits, the 6 of its own among them. A line
just above a class's lower end probes the class below too.

Keys are made for distinct lines: lines met twice or more are told by hash and take part once. A
first pass counts keys in cells (a prefix of the key's hash, 7 bits more than the number of keys
needs, so the share of chance meetings is the same at any size); only keys whose cell holds two
keys or more, one of them held, become rows of the second pass. Candidate buckets are those
keys.

A bucket of more than ``HOT_BUCKET`` lines (a template) is dealt again. Each of its lines has
``FINE`` (t + 1) segments; any t + 1 of them will do, as one of those is whole, so the line holds
the t + 1 that fewest lines probe for, and probes for others' up to t places beside. Lines of a
template that differ in enough places then meet nobody.

Buckets go to ``grouping.linked_classes``, where holders meet those that probe. A pair that the
parities of its characters and of its pairs of neighbouring characters leave room for, and that Spark's own bounded distance does not put
beyond MAX_EDITS, is verified by edit distance: what both lines begin and end with is cut off, and
a banded bit-parallel recurrence runs over the rest: one 64-bit word for a band of
2 x MAX_EDITS + 1 diagonals, one step a character; the distance is held against the pair's own
threshold.

The hashes and places of lines are written once. What moves through shuffles is hashes; lines themselves only for
candidates and for one text of each repeated line, and each text once at the end, when the tables behind it are removed. Hashes of repeated lines and cells are
broadcast up to ``BROADCAST_KEYS`` of them (8 bytes each), and joined beyond.

Null texts stay null and have no lines; null ids come first; rows alike in id and text count as one
document (both keep the first lines); an empty table gives no rows. A very long line is one line:
its keys are as many as those of others. Columns named n_lines or n_removed are replaced, other
columns are kept."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sftlake.llm.common import checkpointed
from sftlake.llm.grouping import linked_classes
from sftlake.sources.scratch import recorded, remove_tables

MAX_EDITS = 5
CHARS_AN_EDIT = 16
MIN_CHARS = 24
BROADCAST_KEYS = 1_000_000  # hashes of 8 bytes that may be broadcast
HOT_BUCKET = 256
SMALL_BUCKET = 8  # lines of buckets up to this size meet few others: no parities of pairs for them
FINE = 3
_COUNTED = "abcdefghijklmnopqrstuvwxyz0123456789 .,-_/:|\u00e9\u00fc"


def _parities(line: Column) -> Column:
    """Bit i: whether the i-th of some characters occurs an odd number of times. An edit changes
    two bits at most, so lines that differ in more than two bits an edit aren't alike."""
    odd = lambda c: (F.length(line) - F.length(F.replace(line, F.lit(c), F.lit("")))) % 2
    return reduce(lambda x, y: x + y, (odd(c).cast("bigint") * F.lit(1 << i).cast("bigint") for i, c in enumerate(_COUNTED)))


def _pair_parities(texts: DataFrame) -> DataFrame:
    """(id, x): x has the parities of the characters, and four words of parities of the pairs of
    neighbouring characters by a hash of the pair. An edit takes away two pairs and adds two at most, so lines
    that differ in more than four of these bits an edit aren't alike."""
    at = texts.select("id", "line", F.explode(F.expr("sequence(1, length(line) - 1)")).alias("i"))
    at = at.select("id", F.expr("xxhash64(substring(line, i, 2))").alias("p"))
    word = lambda i: F.expr(f"bit_xor(if((p & 3) = {i}, shiftleft(1L, cast((p >> 2) & 63 as int)), 0L))").alias(f"p{i}")
    pairs = at.groupBy("id").agg(*map(word, range(4)))
    return texts.select("id", _parities(F.col("line")).alias("c")).join(pairs, "id").select("id", F.struct("c", *(f"p{i}" for i in range(4))).alias("x"))


def _bounds(texts: DataFrame, many: DataFrame) -> DataFrame:
    """(id, x) as ``_pair_parities`` has them, the four words null for texts whose id is not in ``many``."""
    with_pairs = _pair_parities(texts.join(many.hint("shuffle_merge"), "id", "left_semi"))
    others = texts.join(many.hint("shuffle_merge"), "id", "left_anti")
    none = (F.lit(None).cast("bigint").alias(f"p{i}") for i in range(4))
    return with_pairs.unionByName(others.select("id", F.struct(_parities(F.col("line")).alias("c"), *none).alias("x")))


def _may_be_alike(x: Column, y: Column, max_edits: int) -> Column:
    """Whether the parities leave room for ``max_edits``; null words say nothing."""
    differ = lambda n: F.bit_count(x[n].bitwiseXOR(y[n]))
    pairs = sum((differ(f"p{i}") for i in range(4)), F.lit(0)) <= 4 * max_edits
    return (differ("c") <= 2 * max_edits) & F.coalesce(pairs, F.lit(True))


def _trimmed(c: Column) -> Column:
    return F.trim(c, F.lit(" \t\x0b\x0c\r"))


def allowed(size: Column, max_edits: int, chars_an_edit: int) -> Column:
    """Edits that a line of ``size`` characters, the shorter of two, may differ by."""
    return F.least(F.lit(max_edits), F.floor(size / chars_an_edit)).cast("int")


def _class(size: Column) -> Column:
    """Least length of the length class. Classes are at least 8 wide, and those of lines of 16
    characters or more start at multiples of 16, where the number of allowed edits changes."""
    step = F.when(size < 16, 8).when(size < 128, 16).otherwise(64)
    return (size - size % step).cast("int")


def _slots(t: int) -> list[tuple[int, int, int]]:
    """(segment, whether it is counted from the end, shift) of every key of t edits."""
    out = []
    for i in range(t + 1):
        most = min(i, t - i)
        out += [(i, int(i > t - i), shift) for shift in range(-most, most + 1)]
    return out


def _packed(slots: list[tuple[int, int, int]]) -> Column:
    return F.array(*(F.lit((i * 2 + end) * 32 + 16 + shift) for i, end, shift in slots))


def segment_keys(lines: DataFrame, max_edits: int = MAX_EDITS, chars_an_edit: int | None = CHARS_AN_EDIT, fine: int = 0) -> DataFrame:
    """(id, k, j, t, held) of lines (id, line): the key of each segment a line holds (held) and of
    each substring it probes for. Of two lines within the threshold, the shorter holds a key that
    the longer has too. The threshold is ``max_edits``, or with ``chars_an_edit`` (a multiple
    of 16) what ``allowed`` gives for the shorter line.

    Lengths differ by t at most, so the shorter line's class is that of the longer or the one t
    characters below. With ``fine``, a line has ``fine`` times as many segments, all counted from its
    start, and probes t places to either side; then any t + 1 of those it holds will do."""
    if not 0 <= max_edits <= 8 or (chars_an_edit or 16) % 16:
        raise ValueError("a class is 8 characters wide at least, and thresholds change where classes do")
    threshold = lambda n: allowed(n, max_edits, chars_an_edit) if chars_an_edit else F.lit(max_edits)
    by_t = [[(i, 0, s) for i in range(fine * (t + 1)) for s in range(-t, t + 1)] if fine else _slots(t) for t in range(max_edits + 1)]
    at = lines.select("id", "line", F.length("line").alias("n"))
    at = at.select("*", _class(F.col("n")).alias("own"), _class(F.greatest(F.col("n") - threshold(F.col("n")), F.lit(0))).alias("below"))
    at = at.withColumn("least", F.explode(F.array_distinct(F.array("own", "below"))))
    at = at.withColumn("t", threshold(F.col("least")))
    at = at.withColumn("width", F.floor(F.col("least") / ((F.col("t") + 1) * max(fine, 1))).cast("int"))
    at = at.withColumn("at", F.explode(F.get(F.array(*map(_packed, by_t)), F.col("t"))))
    at = at.selectExpr("*", "at >> 6 as j", "(at >> 5) & 1 as end", "(at & 31) - 16 as shift")
    at = at.withColumn("start", F.expr("if(end = 1, n - (t - j + 1) * width, j * width) + shift"))
    at = at.where("start >= 0 and start + width <= n")
    key = F.xxhash64("least", "j", F.expr("substring(line, start + 1, width)"))
    return at.select("id", key.alias("k"), "j", "t", F.expr("shift = 0 and own = least").alias("held"))


def _shared(a: Column, b: Column, most: Column, tail: bool) -> Column:
    """How many characters, ``most`` at most, two strings begin (or end) with alike, found by
    halving; of strings of more than a million characters perhaps fewer."""

    def longer(n: Column, step: Column) -> Column:
        part = lambda s: F.substring(s, F.length(s) - n - step + 1, step) if tail else F.substring(s, n + 1, step)
        return F.when((n + step <= most) & (part(a) == part(b)), n + step).otherwise(n)

    return F.aggregate(F.array(*(F.lit(1 << p) for p in range(20, -1, -1))), F.lit(0), longer)


def trimmed_pair(a: Column, b: Column, keep: int) -> Column:
    """A struct (a, b) of what is left of two strings without their common beginning and end, but
    for ``keep`` characters of each. The edit distance is the same."""

    def ends(v: Column) -> Column:
        return F.struct(v["a"].alias("a"), v["b"].alias("b"), v["head"].alias("head"), _shared(v["a"], v["b"], F.least(F.length(v["a"]), F.length(v["b"])) - v["head"], True).alias("tail"))

    def cut(v: Column) -> Column:
        head, tail = F.greatest(v["head"] - keep, F.lit(0)), F.greatest(v["tail"] - keep, F.lit(0))
        return F.struct(*(F.substring(v[n], head + 1, F.length(v[n]) - head - tail).alias(n) for n in ("a", "b")))

    start = F.struct(a.alias("a"), b.alias("b"), _shared(a, b, F.least(F.length(a), F.length(b)), False).alias("head"))
    return _let(_let(start, ends), cut)


def within_edits(a: Column, b: Column, max_edits: int, threshold: Column | None = None) -> Column:
    """Whether two strings are within ``max_edits`` edits (both longer than that), and within
    ``threshold``, a number of at most max_edits, where it is given.

    The word holds the vertical differences of a band of the edit matrix, its top bit the row
    max_edits below the diagonal. Down to the last row the distance follows that diagonal; after
    it, the last row, one bit lower in each step."""
    t = max_edits
    width = 2 * t + 1
    if width > 60:
        raise ValueError("the band must fit one word")
    full, top = (1 << width) - 1, 1 << (width - 1)
    swap = F.length(a) > F.length(b)
    short, long_ = F.split(F.when(swap, b).otherwise(a), ""), F.split(F.when(swap, a).otherwise(b), "")
    pair = F.struct(short.alias("p"), long_.alias("q"))

    def run(s: Column) -> Column:
        p, q = s["p"], s["q"]
        bend = F.size(p) - t  # steps along the diagonal

        def step(acc: Column, i: Column) -> Column:
            c = F.get(q, i)
            match = F.lit(0).cast("bigint")
            for bit in range(width):
                at = i - t + bit
                match = match.bitwiseOR(F.when((at >= 0) & (F.get(p, at) == c), F.lit(1 << bit).cast("bigint")).otherwise(F.lit(0).cast("bigint")))
            vp, vn = acc["vp"], acc["vn"]
            state = F.struct(match.alias("x"), vp.alias("vp"), vn.alias("vn"))

            def advance(v: Column) -> Column:
                x, vp, vn = v["x"], v["vp"], v["vn"]
                d0 = (x.bitwiseAND(vp) + vp).bitwiseXOR(vp).bitwiseOR(x).bitwiseOR(vn).bitwiseAND(F.lit(full))
                hp = vn.bitwiseOR(F.bitwise_not(d0.bitwiseOR(vp)).bitwiseAND(F.lit(full)))
                hn = d0.bitwiseAND(vp)
                down = F.shiftright(d0, 1)
                return F.struct(
                    d0.alias("d0"), hp.alias("hp"), hn.alias("hn"),
                    hn.bitwiseOR(F.bitwise_not(down.bitwiseOR(hp)).bitwiseAND(F.lit(full))).alias("vp"), down.bitwiseAND(hp).alias("vn"),
                )

            def settle(v: Column) -> Column:
                mask = F.call_function("shiftright", F.lit(top >> 1).cast("bigint"), F.greatest(i - bend, F.lit(0)))
                along = F.when(v["d0"].bitwiseAND(F.lit(top)) == 0, 1).otherwise(0)
                across = F.when(v["hp"].bitwiseAND(mask) != 0, 1).otherwise(0) - F.when(v["hn"].bitwiseAND(mask) != 0, 1).otherwise(0)
                return F.struct(v["vp"].alias("vp"), v["vn"].alias("vn"), (acc["dist"] + F.when(i < bend, along).otherwise(across)).alias("dist"))

            return _let(_let(state, advance), settle)

        start = F.struct(F.lit(full & ~(top - 1) | (top - 1) & ~((1 << t) - 1)).cast("bigint").alias("vp"), F.lit(0).cast("bigint").alias("vn"), F.lit(t).alias("dist"))
        return F.aggregate(F.sequence(F.lit(0), F.size(q) - 1), start, step, lambda acc: acc["dist"])

    most = F.lit(t) if threshold is None else threshold
    return (F.abs(F.length(a) - F.length(b)) <= most) & (_let(pair, run) <= most)


def _let(value: Column, body) -> Column:
    return F.element_at(F.transform(F.array(value), body), 1)


def _lines(docs: DataFrame) -> DataFrame:
    """(doc_id, th, no, line, h): every line that is not blank."""
    rows = docs.select("doc_id", F.xxhash64("text").alias("th"), F.posexplode(F.split("text", "\n")).alias("no", "line"))
    rows = rows.withColumn("line", _trimmed(F.col("line"))).where("line != ''")
    return rows.withColumn("h", F.xxhash64("line"))


def line_table(docs: DataFrame) -> DataFrame:
    """(doc_id, th, no, h): the place and hash of every line that is not blank, written. The lines
    themselves, as large as the texts, are cut from those again where they are needed."""
    return checkpointed(_lines(docs.select("doc_id", "text")).drop("line"))


def _known(ids: DataFrame) -> DataFrame:
    """``ids``, written, as the side of a join: broadcast where they are few."""
    ids = checkpointed(ids)
    return F.broadcast(ids) if ids.count() <= BROADCAST_KEYS else ids.hint("shuffle_merge")


def distinct_texts(docs: DataFrame, lines: DataFrame, min_chars: int) -> DataFrame:
    """(id, line): every distinct line of at least ``min_chars`` characters."""
    texts = _lines(docs.select("doc_id", "text")).select("h", "line").where(F.length("line") >= min_chars)
    twice = checkpointed(lines.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h"))
    if twice.count() > BROADCAST_KEYS:
        return checkpointed(texts.groupBy("h").agg(F.min("line").alias("line")).withColumnRenamed("h", "id"))
    many = texts.join(F.broadcast(twice), "h", "left_semi").groupBy("h").agg(F.min("line").alias("line"))
    return texts.join(F.broadcast(twice), "h", "left_anti").unionByName(checkpointed(many)).withColumnRenamed("h", "id")


def candidate_keys(texts: DataFrame, lines: int, max_edits: int, **scheme) -> DataFrame:
    """(k, id, held): the keys of buckets that hold two lines or more, one of them as a holder."""
    keys = segment_keys(texts, max_edits, **scheme)
    bits = min(64, 7 + (max(lines, 1) * len(_slots(max_edits))).bit_length())
    cell = F.expr(f"shiftrightunsigned(k, {64 - bits})").alias("cell")
    # Few cells are met twice by one task, so the rows are dealt without a first count.
    met = keys.select(cell, "held").repartition("cell").groupBy("cell").agg(F.count("*").alias("n"), F.max("held").alias("held")).where("n > 1 and held").select("cell")
    members = checkpointed(keys.select("k", "id", "held", cell).join(_known(met), "cell", "left_semi").select("k", "id", "held"))
    return _shared_keys(members)


def _shared_keys(members: DataFrame) -> DataFrame:
    alike = members.groupBy("k").agg(F.min("id").alias("lo"), F.max("id").alias("hi"), F.max("held").alias("any")).where("lo != hi and any").select("k")
    return checkpointed(members.join(checkpointed(alike).hint("shuffle_merge"), "k", "left_semi"))


def deal_again(members: DataFrame, texts: DataFrame, max_edits: int) -> DataFrame:
    """``members`` with the buckets of more than HOT_BUCKET lines replaced by finer ones."""
    hot = checkpointed(members.groupBy("k").agg(F.count("*").alias("n")).where(f"n > {HOT_BUCKET}").select("k"))
    if hot.isEmpty():
        return members
    hot = hot.hint("shuffle_merge")
    ids = members.join(hot, "k", "left_semi").select("id").distinct()
    fine = checkpointed(segment_keys(texts.join(checkpointed(ids).hint("shuffle_merge"), "id", "left_semi"), max_edits, fine=FINE))
    asked = fine.groupBy("k").agg(F.count("*").alias("n"))
    own = fine.where("held").join(checkpointed(asked), "k")
    own = own.select("k", "id", "t", F.expr("row_number() over (partition by id order by n, k, j)").alias("rank")).where("rank <= t + 1")
    own = checkpointed(own.select("k", "id").distinct())
    probes = fine.select("k", "id").join(own.select("k").distinct().hint("shuffle_merge"), "k", "left_semi").distinct()
    dealt = probes.join(own.withColumn("held", F.lit(True)), ["k", "id"], "left").select("k", "id", F.coalesce("held", F.lit(False)).alias("held"))
    return members.join(hot, "k", "left_anti").unionByName(_shared_keys(checkpointed(dealt)))


def near_classes(docs: DataFrame, lines: DataFrame, max_edits: int = MAX_EDITS, min_chars: int = MIN_CHARS) -> DataFrame:
    """(id, comp) of the distinct lines (by hash) that have an alike line with another text."""
    texts = distinct_texts(docs, lines, max(min_chars, CHARS_AN_EDIT))
    members = candidate_keys(texts, lines.count(), max_edits)
    texts = checkpointed(texts.join(_known(members.select("id").distinct()), "id", "left_semi"))
    members = deal_again(members, texts, max_edits).withColumnRenamed("held", "leads")
    many = members.groupBy("k").agg(F.count("*").alias("n")).where(F.col("n") > SMALL_BUCKET).select("k")
    many = checkpointed(members.join(checkpointed(many).hint("shuffle_merge"), "k", "left_semi").select("id").distinct())
    members = members.join(checkpointed(_bounds(texts, many)), "id")

    def verify(pairs: DataFrame) -> DataFrame:
        x = texts.select(F.col("id").alias("a"), F.col("line").alias("la"))
        y = texts.select(F.col("id").alias("b"), F.col("line").alias("lb"))
        both = pairs.join(x, "a").join(y, "b")
        most = allowed(F.least(F.length("la"), F.length("lb")), max_edits, CHARS_AN_EDIT)
        both = both.where(F.abs(F.length("la") - F.length("lb")) <= most)
        # Nine pairs of ten are over the threshold; the built-in distance, compiled and cut short at
        # the threshold, drops them at a hundredth of the price of the recurrence.
        both = both.where(F.levenshtein("la", "lb", max_edits) >= 0)
        near = _let(trimmed_pair(F.col("la"), F.col("lb"), max_edits + 1), lambda v: within_edits(v["a"], v["b"], max_edits, most))
        return both.where(near).select("a", "b")

    return linked_classes(members, verify, lambda x, y: _may_be_alike(x, y, max_edits))


def duplicate_lines(docs: DataFrame, max_edits: int = MAX_EDITS, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, th, gone): the numbers of the lines to remove from each document that has any."""
    lines = line_table(docs)
    classes = near_classes(docs, lines, max_edits, min_chars).withColumnRenamed("id", "h")
    place = F.struct("doc_id", "th", "no")
    first = lines.groupBy("h").agg(F.count("*").alias("n"), F.min(place).alias("first"))
    # A line met once and outside any class of near copies stays.
    first = first.join(classes, "h", "left").where("n > 1 or comp is not null").withColumn("comp", F.coalesce("comp", "h"))
    first = checkpointed(first)
    stays = first.groupBy("comp").agg(F.min("first").alias("stays"))
    # Hashes whose class has two lines or more, with the place of the one that stays.
    held = checkpointed(first.select("h", "comp").join(stays, "comp").select("h", "stays"))
    gone = lines.join(held.hint("shuffle_merge"), "h").where(~place.eqNullSafe(F.col("stays")))
    return gone.groupBy("doc_id", "th").agg(F.array_sort(F.collect_set("no")).alias("gone"))


def dedup_lines(docs: DataFrame, max_edits: int = MAX_EDITS, min_chars: int = MIN_CHARS) -> DataFrame:
    """All columns, with ``text`` cut, and n_lines, n_removed (long) added."""
    docs = docs.drop("n_lines", "n_removed")
    with recorded() as paths:  # the texts move once what led to these numbers is gone
        gone = checkpointed(duplicate_lines(docs, max_edits, min_chars).select(F.col("doc_id").alias("__id"), F.col("th").alias("__th"), F.col("gone").alias("__gone")))
    remove_tables(docs.sparkSession, paths, gone)
    out = docs.withColumn("__h", F.xxhash64("text"))
    out = out.join(gone.hint("shuffle_merge"), F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__h") == F.col("__th")), "left")
    lines = F.split("text", "\n")
    kept = _let(F.struct(lines.alias("l"), F.coalesce("__gone", F.array().cast("array<int>")).alias("g")), _without)
    return out.withColumns(
        {
            "n_lines": F.coalesce(F.size(F.filter(lines, lambda x: _trimmed(x) != "")), F.lit(0)).cast("long"),
            "n_removed": F.coalesce(F.size("__gone"), F.lit(0)).cast("long"),
            "text": F.when(F.col("__gone").isNull(), F.col("text")).otherwise(kept),
        }
    ).drop("__h", "__id", "__th", "__gone")


def _without(s: Column) -> Column:
    """The lines whose number isn't listed."""
    stay = F.array_except(F.sequence(F.lit(0), F.size(s["l"]) - 1), s["g"])
    return F.array_join(F.transform(stay, lambda i: F.get(s["l"], i)), "\n")
