"""Benchmark decontamination with a distributed positional inverted index, in DataFrame operations.

The training texts are the indexed side: postings (term, text, pos), stored as a table; a text goes by a hash of itself.
Test windows are looked up from their rarest terms: each posting is shifted by its term's offset in the item, so the terms
of one occurrence meet on one diagonal (item, text, shift). A diagonal that holds as many terms as a window looks up is a
candidate for it; the words of its text then decide, so matches are exact. Terms that a third of all postings hold are
never looked up while a window has rarer ones, and if a window has none, its postings still lie spread over texts.

Defined results: a null text has no words; an item without words has no window; an item of fewer than `n` words is one
window; every row gets its own text's result, whatever its doc_id: null, repeated, or with other texts beside it; an empty
table gives an empty result. Other columns of the input are not read, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assayloom.llm.common import ascii_lower, sha256_hex, small, written

#: What stands between words: all of ASCII but digits and lower-case letters.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Up to so many hashes (8 bytes each) of candidate texts are broadcast; beyond, the join shuffles.
BROADCAST_IDS = 500_000
#: And so many terms of the test items, with their places.
BROADCAST_TERMS = 200_000


def words(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), GAP, -1), "")


def test_windows(items: DataFrame, n: int) -> DataFrame:
    """(item_id, text) -> item_id, item, w, terms: every window of n consecutive words, or the whole of a shorter item.

    item tells rows of one item_id with different texts apart.
    """
    split = items.select("item_id", words(F.col("text")).alias("all")).filter(F.size("all") > 0).distinct()
    split = split.withColumn("item", F.xxhash64("item_id", "all"))
    at = split.select("item_id", "item", "all", F.explode(F.sequence(F.lit(0), F.greatest(F.size("all") - n, F.lit(0)))).alias("w"))
    return at.select("item_id", "item", "w", F.slice("all", F.col("w") + 1, F.lit(n)).alias("terms"))


def word_table(docs: DataFrame) -> DataFrame:
    """doc_id, mark, words of each row, written, so that texts are split once. mark is a hash of the text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return written(docs.select("doc_id", F.xxhash64(text).alias("mark"), words(text).alias("words")), "words")


def term_counts(texts: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """term, n: how often each term of `vocabulary` stands in the texts. Counted before anything is shuffled."""
    return texts.select(F.explode("words").alias("term")).join(vocabulary, "term", "left_semi").groupBy("term").agg(F.count("*").alias("n"))


def postings(texts: DataFrame, terms: DataFrame | None = None) -> DataFrame:
    """term, mark, pos of all words, or of those in `terms`."""
    out = texts.select("mark", F.posexplode("words").alias("pos", "term"))
    return out if terms is None else out.join(terms, "term", "left_semi")


def rarest(windows: DataFrame, counts: DataFrame, r: int) -> DataFrame:
    """item_id, item, w, terms, need: the item positions of the window's r rarest terms. Windows with an unseen term go."""
    each = windows.select("item", "w", F.size("terms").alias("k"), F.posexplode("terms").alias("off", "term")).join(counts, "term")
    group = Window.partitionBy("item", "w")
    ranked = each.withColumn("rank", F.row_number().over(group.orderBy("n", "off"))).withColumn("seen", F.count("*").over(group)).filter("seen = k AND rank <= %d" % r)
    need = ranked.groupBy("item", "w").agg(F.collect_list(F.struct((F.col("w") + F.col("off")).alias("ipos"), "term")).alias("need"))
    return windows.join(need, ["item", "w"])


def match(texts: DataFrame, items: DataFrame, n: int = 10, r: int = 3, slop: int = 8, share: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """Of `word_table` rows, exact phrase hits (mark, item_id, start, len) and proximity matches (mark, item_id).

    A proximity match is an item of which at least `share` of the looked-up places (each counts once) stand in a text,
    displaced against one another by fewer than 2 * `slop` words (in two neighbouring lanes of `slop` shifts). A place
    counts if it stands in the item's order with another one there, so a text read backwards is none.
    """
    windows = test_windows(items, n)
    vocabulary = written(windows.select(F.explode("terms").alias("term")).distinct(), "vocabulary")
    counts = term_counts(texts, small(vocabulary, BROADCAST_TERMS))
    wanted = written(rarest(windows, counts, r), "wanted-windows")
    places = written(wanted.select("item", F.explode("need").alias("x")).select("item", "x.ipos", "x.term").distinct(), "places")
    index = written(postings(texts, small(places.select("term").distinct(), BROADCAST_TERMS)), "postings")
    on_item = index.join(small(places, BROADCAST_TERMS), "term").select("item", "mark", "ipos", (F.col("pos") - F.col("ipos")).alias("shift"))
    need = wanted.select("item", "item_id", "w", "terms", F.size("need").alias("need"))
    wants = need.groupBy("item").agg(F.min("need").alias("least"), F.first("item_id").alias("item_id")).join(places.groupBy("item").agg(F.count("*").alias("total")), "item")
    wants = small(written(wants.withColumn("enough", F.ceil(F.col("total") * share)), "wants"), BROADCAST_TERMS)
    lane = F.floor(F.col("shift") / F.lit(slop))
    # an occurrence lies in one lane, and of two lanes that hold enough together one holds half: no other pair can match
    counted = on_item.groupBy("item", "mark", lane.alias("lane")).agg(F.count("*").alias("n")).join(wants, "item")
    pairs = written(counted.filter(F.col("n") >= F.least("least", F.ceil(F.col("enough") / 2))).select("item", "mark").distinct(), "pairs")
    # rows of one text meet here before they are shuffled, so a text that many rows have counts once
    placed = written(on_item.join(small(pairs, BROADCAST_IDS), ["item", "mark"], "left_semi").distinct(), "placed")
    diagonals = placed.groupBy("item", "mark", "shift").agg(F.count("*").alias("n")).join(wants.select("item", "least"), "item")
    runs = written(diagonals.filter("n >= least").drop("least"), "runs")
    strong = runs.join(need, "item").filter("n >= need").select("mark", "item_id", (F.col("shift") + F.col("w")).alias("start"), "terms").filter("start >= 0")
    marks = small(runs.select("mark").distinct(), BROADCAST_IDS)
    held = texts.select("mark", "words").join(marks, "mark", "left_semi").dropDuplicates(["mark"])
    exact = held.join(strong, "mark").filter(F.slice("words", F.col("start") + 1, F.size("terms")) == F.col("terms"))
    hits = exact.select("mark", "item_id", "start", F.size("terms").alias("len")).distinct()
    lanes = placed.select("item", "mark", "ipos", (F.col("ipos") + F.col("shift")).alias("pos"), F.explode(F.array(lane, lane + 1)).alias("lane")).join(wants.select("item", "enough"), "item")
    by_place = Window.partitionBy("item", "mark", "lane").orderBy("ipos")
    first, last = F.min("pos").over(by_place.rangeBetween(Window.unboundedPreceding, -1)), F.max("pos").over(by_place.rangeBetween(1, Window.unboundedFollowing))
    ordered = lanes.withColumns({"first": first, "last": last}).filter("enough = 1 OR first < pos OR last > pos")
    near = ordered.groupBy("item", "mark", "lane").agg(F.countDistinct("ipos").alias("n"), F.first("enough").alias("enough")).filter("n >= enough").join(wants, "item")
    return hits, near.select("mark", "item_id").distinct()


def contamination(docs: DataFrame, items: DataFrame, n: int = 10, near: bool = True) -> DataFrame:
    """Per row of docs: doc_id, n_words, n_hit, n_items, items_sha256, contaminated (and n_near if `near`)."""
    texts = word_table(docs)
    exact, close = match(texts, items, n)
    hit = written(exact, "hits")
    covered = hit.select("mark", F.explode(F.sequence("start", F.col("start") + F.col("len") - 1)).alias("pos")).distinct().groupBy("mark").agg(F.count("*").alias("n_hit"))
    found = hit.groupBy("mark").agg(F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("items"))
    out = texts.select("doc_id", "mark", F.size("words").cast("long").alias("n_words")).join(small(written(covered.join(found, "mark"), "hit-texts"), BROADCAST_IDS), "mark", "left")
    columns = [
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        sha256_hex(F.coalesce(F.array_join("items", ","), F.lit(""))).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    ]
    if near:
        close = written(close.groupBy("mark").agg(F.count("*").alias("near")), "near-texts")
        out = out.join(small(close, BROADCAST_IDS), "mark", "left")
        columns.append(F.coalesce("near", F.lit(0)).cast("long").alias("n_near"))
    return out.select(*columns)


def decontaminated(docs: DataFrame, items: DataFrame, n: int = 10) -> DataFrame:
    """The rows of docs without any exact window of a test item."""
    exact, _ = match(word_table(docs), items, n)
    gone = written(exact.select("mark").distinct(), "contaminated")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.xxhash64(text).alias("mark"))
    return rows.join(small(gone, BROADCAST_IDS), "mark", "left_anti").select("row.*")
