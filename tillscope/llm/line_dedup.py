"""Line dedup by deletion variants, in DataFrame operations only.

Lines are compared trimmed and in lower case.  A line goes if an earlier
line (smaller document id, then line number) equals it, or, from
``min_words`` words on, lies within a bounded edit distance in words: one
word for short lines, one more for each ``words_per_edit`` words of the
shorter line, ``max_edits`` at most.  Blank lines always stay.

1. Equal lines meet by a 128-bit hash; the earliest position is a partial
   aggregate, so a line that a third of all documents share crosses the
   shuffle as one row per task.
2. Variants.  Cut a line into k + 1 segments, k the edits that its length
   allows.  k edits touch k segments at most, so deleting some k of them
   leaves a variant that the partner has too, with no more edits before it
   than segments before it, and no more behind it than segments behind it.
   A line emits its own variants as hashed keys and, for each length a
   shorter partner may have, the few runs of its words that can be one of
   the partner's variants.  This drops no pair.  Where they stand depends on
   the number of words alone and is joined from a table of lengths.
3. Equal keys.  Keys are not written and are moved once, with the line's
   name: two numbers a row.  Only keys that are a variant of one line and a
   run of another go on, and only their lines are read again.
4. Witnesses.  A line goes if any earlier line is near, so one is enough.
   Every line of a key is held against the key's earliest line; lines that
   have a witness leave the search and stay as witnesses for others.  A
   line that is left is held against the key's lines in blocks of bounded
   size, inside a projection that returns its earliest witness.  So no step
   makes rows of pairs, and a family of near lines costs a row a line.
5. Verification.  Lines are compared as strings of one hashed character a
   word, whose distance is never above the lines' own; the word-level edit
   distance to the witness is verified on the lines themselves.

The unit is a row: rows that repeat an id with other text are documents of
their own, in the order of a hash of their texts; rows that repeat id and
text are alike and fare alike.  Null and empty texts stay as they are; ids
are integers (a row with a null id stays as it is); an empty table gives
an empty result.  Other columns are carried in one struct, so their names
cannot clash.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillscope.llm.common import saved, text_of
from tillscope.llm.vectors import with_groups

#: a smaller table may be broadcast up to this many rows (some tens of bytes each); beyond, both sides are shuffled
BROADCAST_ROWS = 1_000_000
#: lines of most copies told apart before keys are made: any other is at most this part of all lines
HOT_LINES = 100_000
#: lines of a key that one comparison holds
BLOCK = 256


def _lines(docs: DataFrame) -> DataFrame:
    """pos (document, text, line: in reading order) and line of every line that is not blank."""
    return docs.select("doc_id", "text_hash", F.posexplode(F.split("text", "\n")).alias("line_no", "_raw")).select(
        F.struct("doc_id", "text_hash", "line_no").alias("pos"), F.trim("_raw").alias("_raw")).where(
        "_raw != '' and pos.doc_id is not null").select("pos", F.lower("_raw").alias("line"))


def _texts_at(docs: DataFrame, places: DataFrame) -> DataFrame:
    """pos and line of the lines at ``places`` (pos), which are no blank ones; of rows that repeat id and text, one."""
    listed = saved(places.groupBy("pos.doc_id", "pos.text_hash").agg(F.collect_set("pos.line_no").alias("_at")), "wanted-lines")
    # the lists are as long as the places
    few = F.broadcast(listed) if places.count() <= BROADCAST_ROWS else listed
    split = docs.join(few, ["doc_id", "text_hash"]).select("doc_id", "text_hash", F.split("text", "\n").alias("_parts"), F.explode("_at").alias("line_no"))
    return split.select(F.struct("doc_id", "text_hash", "line_no").alias("pos"), F.lower(F.trim(F.element_at("_parts", F.col("line_no") + 1))).alias("line")).dropDuplicates(["pos"])


def _n_words(line: Column) -> Column:
    """As many as ``split`` at blanks finds."""
    return F.octet_length(line) - F.octet_length(F.replace(line, F.lit(" "), F.lit(""))) + 1


def _edits(n: Column, max_edits: int, words_per_edit: int) -> Column:
    """How many words a partner of at least as many words may differ in from a line of ``n`` words."""
    return F.least(F.lit(max_edits), F.greatest(F.lit(1), F.floor(n / words_per_edit).cast("int")))


def _segment_words(n: Column, edits: Column) -> Column:
    """Words in each of ``edits`` + 1 segments; rounded down for long lines, so that lines of like length have equal segments."""
    whole = F.floor(n / (edits + 1)).cast("int")
    return whole - F.pmod(whole, F.greatest(F.lit(1), F.floor(whole / 4).cast("int")))


def layouts(sizes: DataFrame, min_words: int, max_edits: int, words_per_edit: int) -> DataFrame:
    """n, k, i, start, size, own: the runs of words that a line of each of ``sizes`` (n) is found by, its own variants and those a shorter partner's may equal.

    They depend on the number of words alone, so they are worked out once
    for each length that occurs, not for each line.
    """
    upto = sizes.sparkSession.range(max_edits + 1).select(F.col("id").cast("int").alias("id"))
    # a partner shorter by ``less``, its segment ``i``, which stands ``by`` words further on in this line, and the edits this takes
    places = upto.withColumnRenamed("id", "less").crossJoin(upto.withColumnRenamed("id", "i")).withColumn(
        "by", F.explode(F.sequence(-F.col("i"), F.col("i")))).withColumn("need", F.col("i") + F.abs(F.col("by") - F.col("less")))
    own = (F.col("less") == 0) & (F.col("by") == 0)
    placed = sizes.crossJoin(F.broadcast(places)).withColumn("k", _edits(F.col("n") - F.col("less"), max_edits, words_per_edit)).withColumn(
        "size", _segment_words(F.col("n") - F.col("less"), F.col("k"))).withColumn("start", F.col("size") * F.col("i") + F.col("by"))
    fits = (F.col("need") <= F.col("k")) & (F.col("size") > 0) & (F.col("start") >= 0) & (F.col("start") + F.col("size") <= F.col("n")) & (
        F.col("n") >= F.when(own, min_words - max_edits).otherwise(min_words))
    # partners of nearly one length often have one and the same run: once is enough
    return placed.where(fits).groupBy("n", "k", "i", "start", "size").agg(F.max(own).alias("own"))


def _named(h1: Column) -> Column:
    """A line's name: 47 bits of its hash, and a lowest bit for its own variants, unset here.

    Keys have 48 bits, so that fewer bytes are moved.  Runs that have a key,
    or lines that have a name by chance are only compared in vain, unless two
    near lines have one name (one pair in 10**14).
    """
    return F.shiftrightunsigned(h1, 16).bitwiseAND(F.lit(-2))


def with_keys(lines: DataFrame, sizes: DataFrame, min_words: int, max_edits: int, words_per_edit: int) -> DataFrame:
    """key and name of every run of words that a line (h1, line) is found by; the name's lowest bit is set for its own variants."""
    split = lines.select("h1", F.split("line", " ").alias("words")).withColumn("n", F.size("words"))
    placed = split.join(F.broadcast(saved(layouts(sizes, min_words, max_edits, words_per_edit), "layouts")), "n")
    return placed.select(F.xxhash64("k", "i", F.slice("words", F.col("start") + 1, F.col("size"))).bitwiseAND(F.lit(-1 << 16)).alias("key"),
                         _named(F.col("h1")).bitwiseOR(F.col("own").cast("long")).alias("name"))


def _as_string(words: Column, code: Callable[[Column], Column]) -> Column:
    """The words as one character each, from numbers below 900,000 (behind the surrogates; five digits each)."""
    return F.decode(F.unhex(F.array_join(F.transform(words, lambda w: F.concat(F.lit("000"), F.hex(code(w) + 0x10000))), "")), "UTF-32")


def _hashed(word: Column) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(900_000))


def _small(df: DataFrame) -> DataFrame:
    """A written table, marked for broadcast if its counted rows allow it."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _within(a: Column, b: Column, edits: Column) -> Column:
    """The two strings lie within ``edits`` characters."""
    return F.call_function("levenshtein", a, b, edits) >= 0


def _both_sides(pairs: DataFrame, texts: DataFrame, *cols: str) -> DataFrame:
    """``pairs`` (pos, early, bound) with the columns of both lines; only the lines of pairs are moved, and no line's pairs meet in one task."""
    few = _small(pairs)

    def side(name: str) -> DataFrame:
        return texts.select(F.col("pos").alias(name), *[F.col(c).alias(f"{c}_{name}") for c in cols]).join(few, name)

    return side("pos").join(side("early").drop("bound"), ["pos", "early"])


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """``pairs`` (pos, early, bound) whose lines themselves are within the bound."""
    split = _both_sides(pairs, texts, "line").withColumns({f"words_{name}": F.split(f"line_{name}", " ") for name in ("pos", "early")})
    words = split.withColumn("known", F.array_distinct(F.concat("words_pos", "words_early")))
    # distinct words with distinct hashes: the distance of the hashed strings is the lines' own; else number the words
    told_apart = F.size(F.array_distinct(F.transform("known", _hashed))) == F.size("known")
    numbered = lambda c: _as_string(F.col(c), lambda w: F.array_position(F.col("known"), w))
    return words.where(F.when(told_apart, True).otherwise(_within(numbered("words_pos"), numbered("words_early"), F.col("bound")))).select("pos", "early")


def near_lines(lines: DataFrame, repeated: DataFrame, docs: DataFrame, min_words: int, max_edits: int, words_per_edit: int) -> DataFrame:
    """pos, h1 and h2 of the first occurrence of every line that an earlier line lies within the bound of."""
    # of a line with many copies only the first is cut into keys
    hot = repeated.where(F.col("_n") > lines.count() // HOT_LINES + 1).select("h1", "h2", "first")
    once = _lines(docs).select("pos", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit("second"), "line").alias("h2"), "line").join(
        F.broadcast(hot), ["h1", "h2"], "left").where("first is null or pos = first")
    every = with_keys(once, lines.select("n").distinct(), min_words, max_edits, words_per_edit)
    # moved once: which keys are shared is told where a key's rows lie together, so that none is looked up again
    of_key = Window.partitionBy("key")
    shared = every.select("key", "name", F.min("name").over(of_key).alias("_lo"), F.max("name").over(of_key).alias("_hi"), F.bit_or("name").over(of_key).alias("_any")).where(
        (F.shiftright("_lo", 1) != F.shiftright("_hi", 1)) & (F.col("_any").bitwiseAND(F.lit(1)) == 1))
    keys = saved(shared.select("key", F.col("name").bitwiseAND(F.lit(-2)).alias("name")).distinct(), "candidates")
    names = saved(keys.select("name").distinct(), "candidate-names")
    lowest = saved(lines.withColumn("name", _named(F.col("h1"))).join(_small(names), "name", "left_semi").groupBy("name", "h1", "h2").agg(
        F.min("pos").alias("pos"), F.min("n").alias("words")), "candidate-lines")
    texts = saved(_texts_at(docs, lowest).select("pos", "line", _as_string(F.split("line", " "), _hashed).alias("chars")), "candidate-texts")
    members = saved(keys.join(lowest.select("name", "pos", "words"), "name").select("key", "pos", "words"), "members")

    def bound(other: Column) -> Column:
        return _edits(F.least(F.col("words"), other["words"]), max_edits, words_per_edit)

    def comparable(other: Column) -> Column:
        """``other`` (pos, words) is earlier and of a length that may be near."""
        return (other["pos"] < F.col("pos")) & (F.greatest(F.col("words"), other["words"]) >= min_words) & (
            F.abs(F.col("words") - other["words"]) <= bound(other))

    groups = saved(members.groupBy("key").agg(F.count("*").alias("n"), F.min(F.struct("pos", "words")).alias("hub")).where("n > 1"), "hubs")
    met = saved(with_groups(members, groups, "key", F.xxhash64("pos")).where("hub.pos < pos"), "met")
    pairs = saved(met.where(comparable(F.col("hub"))).select("pos", F.col("hub.pos").alias("early"), bound(F.col("hub")).alias("bound")).distinct(), "hub-pairs")
    likely = saved(_both_sides(pairs, texts, "chars").where(_within(F.col("chars_pos"), F.col("chars_early"), F.col("bound"))).groupBy("pos").agg(
        F.min(F.struct("early", "bound")).alias("_w")).select("pos", "_w.early", "_w.bound"), "likely")
    settled = saved(_verified(likely, texts).select("pos"), "settled")
    # what is left is held against all lines of its keys, block by block
    left = saved(met.join(_small(settled), "pos", "left_anti").select("key", "pos", "words", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")), "left")
    near = settled
    if not left.isEmpty():
        near = settled.unionByName(_block_witnesses(left, members, texts, bound, comparable))
    return near.join(lowest.select("pos", "h1", "h2"), "pos")


def _block_witnesses(left: DataFrame, members: DataFrame, texts: DataFrame, bound: Callable[[Column], Column],
                     comparable: Callable[[Column], Column]) -> DataFrame:
    """pos of the lines of ``left`` (key, pos, words, blocks) that any earlier line of their keys (``members``) is near."""
    chars = texts.select("pos", "chars")
    keys_left = _small(saved(left.select("key", "blocks").distinct(), "keys-left"))
    block = F.pmod(F.xxhash64("pos"), F.col("blocks")).cast("int")
    held = saved(members.join(keys_left, "key").select("key", "pos", "words", block.alias("block")), "held")
    packed = chars.join(_small(held), "pos").groupBy("key", "block").agg(F.collect_list(F.struct("pos", "words", "chars")).alias("others"))
    asked = chars.join(_small(left), "pos").select(
        "key", "pos", "words", "chars", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")).join(packed, ["key", "block"])
    alike = lambda other: comparable(other) & _within(F.col("chars"), other["chars"], bound(other))
    witnesses = F.transform(F.filter("others", alike), lambda x: F.struct(x["pos"].alias("early"), bound(x).alias("bound")))
    found = asked.select("pos", witnesses.alias("witnesses"))
    best = saved(found.select("pos", F.array_min("witnesses").alias("_w")).where("_w is not null").groupBy("pos").agg(F.min("_w").alias("_w")).select(
        "pos", "_w.early", "_w.bound"), "witnesses")
    more = saved(_verified(best, texts).select("pos"), "settled")
    # two words of one hash (one in 900,000) may have made a witness: such lines are verified against each
    doubtful = saved(best.join(_small(more), "pos", "left_anti").select("pos"), "doubtful")
    if doubtful.isEmpty():
        return more
    return more.unionByName(_verified(saved(found.join(_small(doubtful), "pos").select("pos", F.inline("witnesses")).distinct(), "doubtful-pairs"), texts).select("pos").distinct())


def dedup_lines(docs: DataFrame, min_words: int = 8, id_col: str = "doc_id", text_col: str = "text", max_edits: int = 1,
                words_per_edit: int = 5) -> DataFrame:
    """doc_id, n_lines, n_removed, text (without the lines that go), row (struct of all input columns)."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("text_hash"),
                       F.struct(*docs.columns).alias("row"))
    lines = saved(_lines(rows).select("pos", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit("second"), "line").alias("h2"),
                                      _n_words(F.col("line")).alias("n")), "lines")
    repeated = saved(lines.groupBy("h1", "h2").agg(F.min("pos").alias("first"), F.count("*").alias("_n")).where("_n > 1"), "repeated-lines")
    near = saved(near_lines(lines, repeated, rows, min_words, max_edits, words_per_edit), "near-lines")
    first = saved(repeated.join(near, ["h1", "h2"], "full_outer").select(
        "h1", "h2", F.coalesce("first", "pos").alias("first"), F.col("pos").isNotNull().alias("gone")), "lines-that-go")
    removed = saved(lines.select("pos", "h1", "h2").join(_small(first), ["h1", "h2"]).where("gone or pos != first").groupBy("pos.doc_id", "pos.text_hash").agg(
        F.collect_set("pos.line_no").alias("_removed")), "removed-lines")
    # the lists are as long as the lines that go, and these are counted
    n_removed = removed.agg(F.coalesce(F.sum(F.size("_removed")), F.lit(0)).alias("n")).first()["n"]
    stay = F.array_except(F.sequence(F.lit(0), F.size("_parts") - 1), F.col("_removed"))
    whole = rows.join(F.broadcast(removed) if n_removed <= BROADCAST_ROWS else removed, ["doc_id", "text_hash"], "left")
    # split once, in a column of its own: inside the lambda a text would be split again for each line that stays
    return whole.withColumn("_parts", F.split("text", "\n")).select(
        "doc_id", F.when(F.col("text").isNull(), 0).otherwise(F.size("_parts")).alias("n_lines"),
        F.coalesce(F.size("_removed"), F.lit(0)).alias("n_removed"),
        F.when(F.col("_removed").isNull(), text_of("text")).otherwise(
            F.array_join(F.transform(stay, lambda i: F.element_at("_parts", i + 1)), "\n")).alias("text"), "row")
