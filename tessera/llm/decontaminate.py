"""Documents that hold passages of benchmark items, by a prefix-filtered set join (operator 9)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import broadcast_if_small, let, saved, text_key

WINDOW_WORDS = 10
SHINGLE_WORDS = 5
#: A hint to broadcast is given only up to so many rows of 24 bytes or fewer.
BROADCAST_ROWS = 500_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def item_words(text: Column) -> Column:
    """Words of ASCII letters, digits and anything beyond ASCII, with only A-Z lower-cased; null text has none."""
    text = F.coalesce(text, F.lit(""))
    plain = F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))
    return F.array_remove(F.split(plain, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), "")


def _hashes(words: Column, n: int) -> Column:
    """The hash of each run of ``n`` words, in order; ``words`` must be cheap to read again."""
    runs = F.slice(words, F.lit(1), F.greatest(F.size(words) - (n - 1), F.lit(0)))
    return F.transform(runs, lambda w, i: F.xxhash64(w, *[F.get(words, i + k) for k in range(1, n)]))


def windows(items: DataFrame, id_col: str, text_col: str, window_words: int, shingle_words: int) -> DataFrame:
    """Rows (win, item_ids, n, width, shingles): the distinct windows of all items, as word arrays.

    ``n`` is the window's number of words and ``width`` that of its shingles. An
    item shorter than a window, but with words, is one window.
    """
    words = items.select(F.col(id_col).cast("string").alias("item_id"), item_words(F.col(text_col)).alias("words")).where(F.size("words") > 0)
    n = F.least(F.size("words"), F.lit(window_words))
    starts = F.explode(F.sequence(F.lit(1), F.size("words") - n + 1))
    cut = words.select("item_id", "words", starts.alias("s"), n.alias("n")).select("item_id", F.expr("slice(words, s, n)").alias("win"))
    own = cut.groupBy("win").agg(F.collect_set("item_id").alias("item_ids")).withColumn("n", F.size("win")).withColumn("width", F.least("n", F.lit(shingle_words)))
    hashes = F.expr("array()").cast("array<bigint>")
    for k in range(shingle_words, 0, -1):
        hashes = F.when(F.col("width") == k, _hashes(F.col("win"), k)).otherwise(hashes)
    return own.withColumn("shingles", hashes)


def _hits(base: DataFrame, items: DataFrame, item_id_col: str, item_text_col: str, window_words: int, shingle_words: int) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, t1, t2, n_words) of ``base`` (doc_id, t1, t2, text), and (t1, t2, n_hit, item_ids) of the texts with a hit.

    All joins go by the text's key, so rows without an id or with a shared one
    are told apart, and equal texts are searched once.
    """
    key = ["t1", "t2"]
    wins = saved(windows(items, item_id_col, item_text_col, window_words, shingle_words), "windows")
    tokens = saved(wins.select("width", F.explode("shingles").alias("token")).distinct(), "tokens")
    count, widths = tokens.agg(F.count("*"), F.sort_array(F.collect_set("width"))).first()
    widths = widths or [shingle_words]

    # One pass over the texts: each shingle that any item has, with its place; and the number of words, as place 0.
    def places(words: Column) -> Column:
        return F.array(*[F.concat(F.array(F.size(words).cast("long")), _hashes(words, k)) for k in widths])

    scanned = base.select("doc_id", *key, let(item_words(F.col("text")), places).alias("by_width"))
    scanned = scanned.select("doc_id", *key, F.posexplode("by_width").alias("k", "hashes")).select("doc_id", *key, F.element_at(F.array(*[F.lit(w) for w in widths]), F.col("k") + 1).alias("width"), F.posexplode("hashes").alias("place", "token"))
    known = broadcast_if_small(tokens.withColumnRenamed("width", "own_width").withColumnRenamed("token", "own_token"), count, BROADCAST_ROWS)
    met = scanned.join(known, (F.col("token") == F.col("own_token")) & (F.col("width") == F.col("own_width")) & (F.col("place") > 0), "left")
    met = saved(met.where("place = 0 or own_token is not null").select("doc_id", *key, "width", "place", "token"), "met")
    lengths = met.where(f"place = 0 and width = {widths[0]}").select("doc_id", *key, F.col("token").alias("n_words"))
    found = met.where("place > 0").select(*key, "width", "place", "token").distinct()

    # The rarest token of each window in the corpus; a window with a token that never occurs is out.
    often = found.groupBy("width", "token").agg(F.count("*").alias("n_found"))
    ranked = wins.select("win", "n", "width", F.size("shingles").alias("n_tokens"), F.posexplode("shingles").alias("offset", "token")).join(often, ["width", "token"])
    prefix = ranked.groupBy("win", "n", "width").agg(F.min(F.struct("n_found", "offset", "token")).alias("p"), (F.count("*") == F.max("n_tokens")).alias("all_occur")).where("all_occur").select("win", "n", "width", "p.offset", "p.token")
    starts = found.join(prefix, ["width", "token"]).select(*key, "win", "n", (F.col("place") - F.col("offset")).alias("start"))
    at_start = starts.where("start >= 1").groupBy(*key).agg(F.collect_set(F.struct("start", "n", "win")).alias("starts"))

    # The words themselves, of the texts with a candidate only.
    texts = base.select(*key, "text").join(at_start, key).dropDuplicates(key).select(*key, "starts", item_words(F.col("text")).alias("words"))
    fits = lambda x: (x["start"] + x["n"] - 1 <= F.size("words")) & (F.slice(F.col("words"), x["start"], x["n"]) == x["win"])
    held = saved(texts.select(*key, F.explode(F.filter("starts", fits)).alias("s")).select(*key, "s.*"), "held")
    words_hit = held.select(*key, F.explode(F.expr("sequence(start, start + n - 1)")).alias("w")).distinct().groupBy(*key).agg(F.count("*").alias("n_hit"))
    ids = held.join(wins.select("win", "item_ids"), "win").select(*key, F.explode("item_ids").alias("item_id")).groupBy(*key).agg(F.array_sort(F.collect_set("item_id")).alias("item_ids"))
    return lengths, words_hit.join(ids, key, "left")


def item_hits(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text", window_words: int = WINDOW_WORDS, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """Rows (doc_id, n_words, n_hit, item_ids), one per row of ``docs``.

    A window is ``window_words`` successive words of an item; a document word is
    hit if it stands inside any occurrence of any window; ``item_ids`` are the
    items with occurring windows, as sorted strings (items without an id hit,
    but are not listed).

    Shingles of five words are the tokens of the set join. Containment has to be
    complete, so one token, the rarest in the corpus, is the necessary prefix of
    a window. Where it occurs, its place gives the only start possible; the
    window has to fit between there and the end of the text, and its words are
    then compared with the text's.

    Null or empty texts have no words and no hits; items without words are
    ignored; rows that repeat, share an id or have none get their own results;
    empty tables of either kind give no rows or no hits. Only the shingles of
    the benchmark are broadcast, after they are counted; beyond
    ``BROADCAST_ROWS`` both sides are shuffled.
    """
    base = docs.select(F.col(id_col).alias("doc_id"), *text_key(F.col(text_col)), F.col(text_col).alias("text"))
    lengths, results = _hits(base, items, item_id_col, item_text_col, window_words, shingle_words)
    return lengths.join(results, ["t1", "t2"], "left").select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("item_ids", F.expr("cast(array() as array<string>)")).alias("item_ids"))


def clean_documents(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no window of any item.

    Each row is judged by its own text, whatever its id: rows without an id go
    if they hold one, and clean rows stay though another row with their id goes.
    Null and empty texts hold none; without items all rows stay.
    """
    rows = docs.select(F.struct("*").alias("row"), *text_key(docs["text"]))
    _, dirty = _hits(rows.select(F.col("row.doc_id").alias("doc_id"), "t1", "t2", F.col("row.text").alias("text")), items, "item_id", "text", WINDOW_WORDS, SHINGLE_WORDS)
    return rows.join(dirty.where("n_hit > 0").select("t1", "t2"), ["t1", "t2"], "left_anti").select("row.*")
