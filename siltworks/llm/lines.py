"""Line dedup by an exact set-similarity join, in DataFrame functions only.

A line is the set of its lower-case words. Lines with equal sets are one class, placed at its
first line. Words of a class are ordered by rarity; two sets of Jaccard similarity t share a
word within the first n - ceil(t * n) + 1 of either, and within the first n - ceil(2t / (1 + t) * n)
+ 1 of the smaller one. So only these prefixes are posted and joined, long ones with short ones,
under length and positional filters and a bound from 64-bit signatures of the sets. Pairs that stay
are confirmed on their lines.

Rarity comes from a table of word counts of fixed size (SKETCH buckets of word hashes, a byte
each, summed over all lines); any total order keeps the join exact, the counts make it
selective. The table is one array, the value of a scalar subquery, so ordering needs no join.

The words of a text are hashed once, into a table of lines from which they are counted, put in
order and compared.

Posting lists of words that are counted more often than SHORT says come of common words and of
passages with many variants. To make no square of these, each class first meets only the likeliest of the
first and the BEFORE classes just before it in each of its long lists, and what that confirms needs no
other partner; the classes left over then meet all earlier classes of all their lists, the likeliest first.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltworks.llm.common import WORD, cut, table, written

SKETCH = 1 << 21
#: Buckets are put in order in so many parts, then the parts.
PARTS = 1 << 11
#: Up to so many lines (of a few dozen bytes) are looked up by broadcast, more by a shuffle.
LOOKED_UP = 500_000
BEFORE = 3
#: Lists of words up to this rarity (four times the binary logarithm of a count) are short: below 305 classes.
#: A row of one meets fewer than so many others; their number is bounded, however many rows there are.
SHORT = 32
#: Bytes of a file's dictionary of word hashes: most words of a file of the table of lines are repeated ones.
DICTIONARY = 8 << 20


#: White space within a line.
BLANKS = " \t\x0b\x0c\r"


def plain_lines(text_col: str) -> Column:
    """Lines of a text, with white space as spaces."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    spaced = reduce(lambda x, c: F.replace(x, F.lit(c), F.lit(" ")), BLANKS[1:], text)
    # most texts have none of these, and to look for one is faster than to replace it
    some = reduce(lambda x, y: x | y, [F.contains(text, F.lit(c)) for c in BLANKS[1:]])
    return F.split(F.when(some, spaced).otherwise(text), "\n", -1)


def word_hashes(line: Column) -> Column:
    """Distinct hashes of a line's words in lower case."""
    words = F.transform(F.split(F.lower(line), " ", -1), lambda w: F.xxhash64(w))
    return F.array_remove(F.array_distinct(words), F.xxhash64(F.lit("")))


def lines_of(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("doc_id"), F.posexplode(plain_lines(text_col)).alias("line_no", "line"))


def rarity_table(docs: DataFrame, text_col: str) -> DataFrame:
    """The rarity of the words of all texts, each as often as it occurs."""
    # joining the lines by spaces is faster than a replacement of their ends
    words = docs.select(F.explode(F.split(F.lower(F.array_join(plain_lines(text_col), " ")), " ", -1)).alias("w")).where("w <> ''")
    return _rarity(words.select(F.xxhash64("w").alias("h")))


def _rarity(hashes: DataFrame) -> DataFrame:
    """One row, one array: for each bucket of word hashes h a coarse logarithm of its count.

    Its size is fixed: SKETCH entries of a byte.
    """
    bucket = F.col("h").bitwiseAND(F.lit(SKETCH - 1)).cast("int").alias("b")
    # buckets without a row are of rank 0, as those of one word are
    counts = hashes.groupBy(bucket).agg(F.count("*").alias("n")).where("n > 1")
    rank = F.least(F.lit(127), F.floor(4 * F.log2(F.col("n").cast("double")))).cast("int")
    width = SKETCH // PARTS
    part = F.floor(F.col("b") / width).cast("int").alias("part")
    held = counts.select(part, F.shiftleft("b", 7).bitwiseOR(rank).alias("packed"))
    # every part has a row, whether a word falls into it or not
    held = held.union(hashes.sparkSession.range(PARTS).select(F.col("id").cast("int"), F.lit(None).cast("int")))
    start = F.col("part") * width
    absent = F.array_except(F.sequence(start, start + (width - 1)), F.transform("held", lambda x: F.shiftright(x, 7)))
    packed = F.sort_array(F.concat("held", F.transform(absent, lambda b: F.shiftleft(b, 7))))
    parts = held.groupBy("part").agg(F.collect_list("packed").alias("held"))
    parts = parts.select("part", F.transform(packed, lambda x: x.bitwiseAND(F.lit(127)).cast("tinyint")).alias("rank"))
    in_order = F.array_sort(F.collect_list(F.struct("part", "rank")))
    return parts.agg(F.flatten(F.transform(in_order, lambda x: x["rank"])).alias("rarity"))


#: A null id comes first.
NO_ID = -(1 << 63)


def line_words(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row for each line: doc_id, at, and the distinct hashes of its words; written.

    at is the line's number and its number of words in one long, and a null id the least long.
    """
    lines = lines_of(docs, id_col, text_col).select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"), "line_no", word_hashes(F.col("line")).alias("words"))
    at = F.shiftleft(F.col("line_no").cast("long"), 32).bitwiseOR(F.size("words").cast("long"))
    return written(lines.select("doc_id", at.alias("at"), "words"), {"parquet.dictionary.page.size": DICTIONARY})


def line_classes(docs: DataFrame, threshold: int, id_col: str, text_col: str) -> DataFrame:
    """The classes of the lines of all texts, as `word_classes` has them."""
    return word_classes(line_words(docs, id_col, text_col), threshold)


def word_classes(lines: DataFrame, threshold: int) -> DataFrame:
    """One row for each distinct set of words: doc_id and at of its first line, sig, prefix; written.

    The prefix holds the rarest words, as one long: rarity, then hash. sig has a bit for each of
    64 classes of words that the set has an odd number of.
    """
    # seven bits of rarity above 56 bits of the hash
    # never null, so that the words are sorted as plain longs
    rank = lambda h: F.coalesce(F.get("rarity", h.bitwiseAND(F.lit(SKETCH - 1)).cast("int")).cast("long"), F.lit(0).cast("long"))
    ranked = lambda h: F.shiftleft(rank(h), 56).bitwiseOR(h.bitwiseAND(F.lit((1 << 56) - 1)))
    # sets without words are no class
    some = lines.where(_words("at") > 0).withColumn("rarity", _rarity(lines.select(F.explode("words").alias("h"))).scalar())
    hashed = some.select("doc_id", "at", F.sort_array(F.transform("words", ranked)).alias("words"))
    bit = lambda w: F.call_function("shiftleft", F.lit(1).cast("long"), w.bitwiseAND(F.lit(63)).cast("int"))
    n = F.size("words")
    keyed = hashed.select(
        F.xxhash64("words").alias("h1"),
        F.xxhash64(F.lit(1), "words", n).alias("h2"),
        F.struct(
            "doc_id",
            "at",
            F.aggregate("words", F.lit(0).cast("long"), lambda s, w: s.bitwiseXOR(bit(w))).alias("sig"),
            F.slice("words", F.lit(1), _prefix(n, threshold)).alias("prefix"),
        ).alias("first"),
    )
    first = keyed.groupBy("h1", "h2").agg(F.min("first").alias("first"))
    return written(first.select("first.*"), {"parquet.dictionary.page.size": DICTIONARY})


def postings(classes: DataFrame, *columns: str) -> DataFrame:
    """(w, doc_id, at, sig, pos, *columns): classes under the words of their prefixes.

    A list has at most as many classes as its word's bucket has words, which the rarity that a word
    starts with tells. A word of rarity 0 is the only one counted in its bucket: no other line has it.
    """
    rows = classes.select("doc_id", "at", "sig", *columns, F.posexplode("prefix").alias("pos", "w"))
    return rows.where(F.shiftright("w", 56) > 0).select("w", "doc_id", "at", "sig", "pos", *columns)


def posting_lists(classes: DataFrame, threshold: int) -> DataFrame:
    """(doc_id, at, best): for each row of a long list the likeliest of a few earlier classes.

    These are of about as many words in the same list, the first and the ones just before, and
    best is (apart, doc_id, at). Only words of short prefixes are looked at, which the variants of a
    passage mostly share.
    """
    rows = postings(classes).where((F.shiftright("w", 56) > SHORT) & (F.col("pos") < _short_prefix(_words("at"), threshold)))
    rows = rows.withColumn("band", F.floor(F.log(_words("at").cast("double")) / math.log(100 / threshold)))
    order, own = Window.partitionBy("w", "band").orderBy("doc_id", "at"), F.struct("doc_id", "at", "sig", "pos")
    rows = rows.withColumns({"c0": F.first(own).over(order), **{f"c{k}": F.lag(own, k).over(order) for k in range(1, BEFORE + 1)}})
    likely = []
    for k in range(BEFORE + 1):
        o = {c: F.col(f"c{k}.{c}") for c in ("doc_id", "at", "sig", "pos")}
        other_line = (F.col("doc_id") != o["doc_id"]) | (F.col("at") != o["at"])
        likely.append(F.when(other_line & _filters(threshold, o, F.col("pos")), F.struct(_apart(o["sig"]).alias("apart"), o["doc_id"].alias("doc_id"), o["at"].alias("at"))))
    return rows.select("doc_id", "at", F.least(*likely).alias("best")).where("best is not null")


def _words(at: Column | str) -> Column:
    return (F.col(at) if isinstance(at, str) else at).bitwiseAND(F.lit((1 << 32) - 1)).cast("int")


def _prefix(n: Column, threshold: int) -> Column:
    return n - F.ceil(n * threshold / F.lit(100)).cast("int") + 1


def _short_prefix(n: Column, threshold: int) -> Column:
    """The first words of a set that meet the prefix of any similar set of as many words or more."""
    return n - F.ceil(n * (2 * threshold) / F.lit(100 + threshold)).cast("int") + 1


def _apart(o_sig: Column) -> Column:
    """At most so many words are in just one of the two sets: each flips one bit."""
    return F.bit_count(F.col("sig").bitwiseXOR(o_sig))


def _filters(threshold: int, o: dict[str, Column], pos: Column) -> Column:
    """Whether a match at pos with another set o at its pos may be the first of a similar pair.

    The lengths must be close, enough words must follow in both sets, and the signatures may
    not differ by more than the words that similar sets don't share. Similar sets pass at the
    first word that they share, so no similar pair is lost.
    """
    n, o_n = _words(F.col("at")), _words(o["at"])
    length = 100 * F.least(n, o_n) >= threshold * F.greatest(n, o_n)
    position = (100 + threshold) * F.least(n - pos, o_n - o["pos"]) >= threshold * (n + o_n)
    return length & ((100 + threshold) * _apart(o["sig"]) <= (100 - threshold) * (n + o_n)) & position


PAIR = ["doc_id", "at", "o_doc_id", "o_at"]


def _meetings(posted: DataFrame, threshold: int) -> DataFrame:
    """(*PAIR, apart): pairs within the lists that pass the filters, the later class first and open.

    Classes meet those of as many words or fewer that have the word in their short prefix.
    """
    # a row is shuffled twice, so it is kept short: half of a word's hash, pos and open are one long
    tag = F.shiftleft("pos", 1).bitwiseOR(F.col("open").cast("int")).cast("long")
    key = F.shiftleft(F.hash("w").cast("long"), 32).bitwiseOR(tag).alias("key")
    less = posted.where(F.col("pos") < _short_prefix(_words("at"), threshold)).select(key.alias("o_key"), *[F.col(c).alias(f"o_{c}") for c in ("doc_id", "at", "sig")])
    word = lambda k: F.shiftright(k, 32)
    pos = lambda k: F.shiftright(k.bitwiseAND(F.lit((1 << 32) - 1)), 1).cast("int")
    n, o_n = _words("at"), _words("o_at")
    earlier = (F.col("o_doc_id") < F.col("doc_id")) | ((F.col("o_doc_id") == F.col("doc_id")) & (F.col("o_at") < F.col("at")))
    o = {"at": F.col("o_at"), "sig": F.col("o_sig"), "pos": pos(F.col("o_key"))}
    meets = _filters(threshold, o, pos(F.col("key"))) & ((o_n < n) | ((o_n == n) & earlier))
    meets &= F.when(earlier, F.col("key")).otherwise(F.col("o_key")).bitwiseAND(F.lit(1)) == 1
    ordered = [F.when(earlier, F.col(c)).otherwise(F.col(f"o_{c}")).alias(c) for c in ("doc_id", "at")]
    ordered += [F.when(earlier, F.col(f"o_{c}")).otherwise(F.col(c)).alias(f"o_{c}") for c in ("doc_id", "at")]
    joined = posted.select(key, "doc_id", "at", "sig").join(less, word(F.col("key")) == word(F.col("o_key")))
    return joined.where(meets).select(*ordered, _apart(F.col("o_sig")).alias("apart")).distinct()


def _sets(pairs: DataFrame, lines: DataFrame) -> DataFrame:
    """The rows of lines that the pairs name."""
    here, there = pairs.select("doc_id", "at"), pairs.select(F.col("o_doc_id").alias("doc_id"), F.col("o_at").alias("at"))
    wanted = cut(here.union(there).distinct())
    if wanted.count() <= LOOKED_UP:
        wanted = F.broadcast(wanted)
    # as a table, of which both sides of the joins of pairs read one shuffle
    return written(lines.join(wanted, ["doc_id", "at"], "left_semi"), {"parquet.dictionary.page.size": DICTIONARY})


def _confirmed(pairs: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """(doc_id, at) of the pairs whose lines are as similar as asked for."""
    # rows that share an id may have other lines at a place: the number of words, in at, tells
    a = sets.select(F.col("doc_id").alias("x"), F.col("at").alias("y"), "words")
    b = sets.select(F.col("doc_id").alias("o_x"), F.col("at").alias("o_y"), F.col("words").alias("o_words"))
    common = F.size(F.array_intersect("words", "o_words"))
    hit = (100 + threshold) * common >= threshold * (F.size("words") + F.size("o_words"))
    one = pairs.join(a, (F.col("doc_id") == F.col("x")) & (F.col("at") == F.col("y")))
    both = one.join(b, (F.col("o_doc_id") == F.col("o_x")) & (F.col("o_at") == F.col("o_y")))
    return cut(both.where(hit).select("doc_id", "at").distinct())


def _likeliest(met: DataFrame) -> DataFrame:
    """PAIR: each class of (doc_id, at, best) with the other one of its least best."""
    best = met.groupBy("doc_id", "at").agg(F.min("best").alias("best"))
    return cut(best.select("doc_id", "at", F.col("best.doc_id").alias("o_doc_id"), F.col("best.at").alias("o_at")))


def repeated_places(lines: DataFrame, classes: DataFrame, threshold: int) -> DataFrame:
    """(doc_id, at) of every class with an earlier class of similarity threshold / 100 or more.

    First each class is compared with the likeliest of a few earlier ones in its long lists. Those
    that this didn't settle meet all earlier classes of their lists, and are compared with the
    likeliest of them, then, if that didn't settle it either, with the others.
    """
    leaders = _likeliest(posting_lists(classes, threshold))
    by_leader = _confirmed(leaders, _sets(leaders, lines), threshold)
    settled = by_leader.withColumn("settled", F.lit(True))
    if by_leader.count() <= LOOKED_UP:
        settled = F.broadcast(settled)
    flagged = classes.join(settled, ["doc_id", "at"], "left").withColumn("open", F.col("settled").isNull())
    near = cut(_meetings(postings(flagged, "open"), threshold))
    likeliest = _likeliest(near.select("doc_id", "at", F.struct("apart", F.col("o_doc_id").alias("doc_id"), F.col("o_at").alias("at")).alias("best")))
    sets = _sets(near, lines)
    by_likeliest = _confirmed(likeliest, sets, threshold)
    left = without(near.select(*PAIR), by_likeliest).join(likeliest, PAIR, "left_anti")
    left = cut(left)
    return by_leader.union(by_likeliest).union(_confirmed(left, _sets(left, sets), threshold))


def without(rows: DataFrame, places: DataFrame) -> DataFrame:
    """rows (doc_id, at, ...) that aren't at these places; few places are broadcast."""
    gone = F.broadcast(places) if places.count() <= LOOKED_UP else places
    return rows.join(gone, ["doc_id", "at"], "left_anti")


def kept_lines(docs: DataFrame, threshold: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, kept): numbers, from 0, of the lines with words that stay, for ids that keep any.

    Lines come in order of id (null first) and number. A line goes if any earlier line, itself
    removed or not, has 100 * intersection >= threshold * union with it. Lines without words
    are never judged. Rows that share an id count as one document whose lines share places: a
    place stays if any of its lines does, and of two lines at one place the one of fewer words
    is the earlier.
    """
    lines = line_words(docs, id_col, text_col)
    classes = word_classes(lines, threshold)
    gone = cut(repeated_places(lines, classes, threshold))
    stay = without(classes.select("doc_id", "at"), gone).select(F.nullif("doc_id", F.lit(NO_ID)).alias("doc_id"), F.shiftright("at", 32).cast("int").alias("ln"))
    return stay.groupBy("doc_id").agg(F.array_sort(F.collect_set("ln")).alias("kept"))


def drop_repeated_lines(docs: DataFrame, threshold: int = 80, id_col: str = "doc_id", text_col: str = "text", keep_emptied: bool = True) -> DataFrame:
    """docs without the lines that repeat an earlier line; all columns stay.

    A text that loses all its lines becomes empty, or its row goes if keep_emptied is not set;
    texts without words are never touched, null texts stay null and n_chars, where docs has it,
    follows the text. An empty table gives no rows.
    """
    kept = kept_lines(docs, threshold, id_col, text_col)
    kept = kept.select(F.col("doc_id").alias("_id"), F.col("kept").alias("_kept"))
    rows = docs.select(F.struct(*docs.columns).alias("_row"))
    joined = rows.join(kept, F.col(f"_row.{id_col}").eqNullSafe(F.col("_id")), "left")
    text, numbers = F.col(f"_row.{text_col}"), F.coalesce("_kept", F.array().cast("array<int>"))
    lines = F.split(text, "\n", -1)
    stay = F.filter(lines, lambda x, i: ~F.regexp_like(x, F.lit(WORD)) | F.array_contains(numbers, i))
    kept_text = F.array_join(stay, "\n")
    if not keep_emptied:
        joined = joined.where(F.col("_kept").isNotNull() | text.isNull() | ~F.regexp_like(text, F.lit(WORD)))
    new = {text_col: kept_text, "n_chars": F.length(kept_text).cast("long")}
    return joined.select(*[new.get(c, F.col(f"_row.`{c}`")).alias(c) for c in docs.columns])


def op8(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    kept = kept_lines(docs).withColumnRenamed("doc_id", "_id")
    lines = docs.select("doc_id", F.split(F.coalesce("text", F.lit("")), "\n", -1).alias("_lines"))
    # from the left, so that only the white space before the first word is looked at
    filled = F.array_compact(F.transform("_lines", lambda x, i: F.when(F.ltrim(x, F.lit(BLANKS)) != "", i)))
    judged = lines.select("doc_id", F.size("_lines").cast("long").alias("n_lines"), filled.alias("_filled"))
    joined = judged.join(kept, judged["doc_id"].eqNullSafe(kept["_id"]), "left")
    removed = F.array_except("_filled", F.coalesce("kept", F.array().cast("array<int>")))
    return joined.select("doc_id", "n_lines", F.size(removed).cast("long").alias("n_removed"), F.array_join(removed, ",").alias("removed_lines"))
