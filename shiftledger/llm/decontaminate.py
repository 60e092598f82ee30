"""Benchmark decontamination by a prefix-filtered set join, in DataFrame functions only.

A text's words are its runs of letters, digits and signs beyond ASCII, A-Z lower-cased. A window is so
many consecutive words of an item (an item of fewer words is one window), seen as the set of its
shingles of ``shingle_words`` words. A text can hold a window only if it holds every shingle of it, so
a window's prefix, in an order of all shingles by rarity, is its rarest shingle alone:

* the shingles of all windows are counted over all texts; a window with a shingle that no text has is
  dropped, since nothing can hold it;
* shingles of the texts meet the rarest shingle of each window that is left;
* where they meet, the shingle's place in the window says where the window begins (positional bound)
  and ends (length bound), and the words between are compared one by one.

Texts are known by their digest from then on, so copies of one text weigh no more than one.

Null and word-less texts have no words and hit nothing; items without words have no windows. Items that
share an id are one item; windows of items without id mark words but are neither counted nor listed.
Repeated documents are answered each for itself; other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage

WINDOW_WORDS = 10
SHINGLE_WORDS = 3
#: Rows of windows, shingles, hits or items (each below 200 bytes but for its words) that a join
#: broadcasts at most; more are joined by shuffle.
BROADCAST_ROWS = 200_000
#: Bytes of windows that a join broadcasts at most: words may be long where a script has no blanks.
BROADCAST_BYTES = 1 << 26

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Words of a text in their own case; none for a null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), _BETWEEN), "")


def _lowered(word: Column) -> Column:
    """A-Z lower-cased and nothing else; the usual word is all ASCII, where ``lower`` is quick."""
    ascii_only = F.octet_length(word) == F.char_length(word)
    return F.when(ascii_only, F.lower(word)).otherwise(F.translate(word, _UPPER, _LOWER))


def _shingle(words: Column, at: Column, n: int) -> Column:
    return F.xxhash64(F.lit(n), *[_lowered(F.get(words, at + i)) for i in range(n)])


def item_windows(items: DataFrame, window: int = WINDOW_WORDS) -> DataFrame:
    """``item_id``, ``window`` (digest), ``n`` and ``words`` of every distinct window of every item."""
    words = items.select(
        "item_id", words_of(F.translate(F.col("text"), _UPPER, _LOWER)).alias("words")
    ).where(F.size("words") > 0)
    begins = F.explode(F.sequence(F.lit(0), F.greatest(F.size("words") - window, F.lit(0))))
    cut = words.select("item_id", "words", begins.alias("begin")).select(
        "item_id", F.slice("words", F.col("begin") + 1, window).alias("words")
    )
    return cut.select(
        "item_id", F.sha2(F.array_join("words", " "), 256).alias("window"), F.size("words").alias("n"), "words"
    ).distinct()


def _window_shingles(windows: DataFrame, shingle_words: int) -> DataFrame:
    """``window``, ``key`` and ``offset`` of every shingle; a shorter window is its own shingle."""
    parts = []
    for width in range(1, shingle_words + 1):
        here = F.col("n") >= width if width == shingle_words else F.col("n") == width
        offsets = F.explode(F.sequence(F.lit(0), F.col("n") - width))
        parts.append(
            windows.where(here)
            .select("window", "words", offsets.alias("offset"))
            .select("window", _shingle(F.col("words"), F.col("offset"), width).alias("key"), "offset", F.lit(width).alias("width"))
        )
    found = parts[0]
    for part in parts[1:]:
        found = found.union(part)
    return found


def _text_shingles(docs: DataFrame, widths: list[int]) -> DataFrame:
    """``row`` (the text's digest, then its words), ``at`` and ``key`` of every shingle of every text.

    The digest leads the words because Spark evaluates once a text what a generator reads, and the
    rest once a row. Shingles cut short by the end of a text only meet windows that do not fit.
    """
    row = F.concat(F.array(F.sha2(F.coalesce("text", F.lit("")), 256)), words_of(F.col("text")))
    # the outer form lets no filter on the array's size be pushed below, which would split texts twice
    placed = docs.select(row.alias("row")).select("row", F.posexplode_outer("row").alias("at", "word"))
    keys = [_shingle(F.col("row"), F.col("at"), width) for width in widths]
    key = keys[0] if len(keys) == 1 else F.explode(F.array(*keys))
    return placed.select("row", "at", key.alias("key")).where("at > 0")


def _hinted(df: DataFrame, fits: bool) -> DataFrame:
    return F.broadcast(df) if fits else df


def _small(df: DataFrame, rows: int) -> bool:
    """Whether a staged table has few enough rows to be broadcast; more are not counted."""
    return df.limit(rows + 1).count() <= rows


def _prefixes(docs: DataFrame, windows: DataFrame, shingle_words: int, rows: int) -> DataFrame:
    """``key``, ``offset``, ``window``, ``n`` and ``text``: each window's rarest shingle, if texts hold all."""
    shingles = stage(_window_shingles(windows, shingle_words), "window-shingles")
    widths = sorted(r.width for r in shingles.select("width").distinct().collect())
    if not widths:
        nothing = windows.select(F.lit(0).cast("bigint").alias("key"), F.lit(0).alias("offset"), "window", "n", F.lit("").alias("text"))
        return nothing.where("false")
    keys = stage(shingles.select("key").distinct(), "window-keys")
    counted = stage(
        _text_shingles(docs, widths).select("key")
        .join(_hinted(keys, _small(keys, rows)), "key", "left_semi")
        .groupBy("key").agg(F.count(F.lit(1)).alias("times")),
        "shingle-counts",
    )
    rarest = shingles.join(_hinted(counted, _small(counted, rows)), "key", "left").groupBy("window").agg(
        F.min(F.struct(F.coalesce("times", F.lit(0)).alias("times"), "key", "offset")).alias("least")
    )
    return (
        rarest.where("least.times > 0")
        .join(windows, "window")
        .select("least.key", "least.offset", "window", "n", F.array_join("words", " ").alias("text"))
    )


def window_hits(
    docs: DataFrame, items: DataFrame, window: int = WINDOW_WORDS, shingle_words: int = SHINGLE_WORDS,
    broadcast_rows: int = BROADCAST_ROWS,
) -> tuple[DataFrame, DataFrame]:
    """Where windows occur, and which items they are of; both staged.

    The first has ``text`` (the digest of a text), ``begin`` (in words, from 0), ``n`` and ``window``
    for every occurrence in every distinct text, the second ``item_id`` and ``window``.
    """
    named = stage(item_windows(items, window), "windows")
    windows = stage(named.select("window", "n", "words").distinct(), "distinct-windows")
    prefixes = stage(_prefixes(docs, windows, min(shingle_words, window), broadcast_rows), "prefixes")
    widths = [r.width for r in prefixes.select(F.least("n", F.lit(min(shingle_words, window))).alias("width")).distinct().collect()]
    if not widths:
        found = prefixes.select(F.col("window").alias("text"), F.lit(0).alias("begin"), "n", "window")
    else:
        before = F.least(F.col("at") - 1, F.lit(window - 1))
        near = _text_shingles(docs, sorted(widths)).select(
            "key",
            F.get("row", F.lit(0)).alias("digest"),
            (F.col("at") - 1).alias("at"),
            before.alias("before"),
            F.slice("row", F.col("at") - before + 1, before + window).alias("near"),
        )
        size = prefixes.agg(F.coalesce(F.sum(F.octet_length("text") + 120), F.lit(0))).first()[0]
        fits = size <= BROADCAST_BYTES and _small(prefixes, broadcast_rows)
        skipped = F.col("before") - F.col("offset")
        words = F.slice("near", F.greatest(skipped, F.lit(0)) + 1, F.col("n"))
        found = (
            near.join(_hinted(prefixes, fits), "key")
            .where((skipped >= 0) & (skipped + F.col("n") <= F.size("near")))
            .where(F.translate(F.array_join(words, " "), _UPPER, _LOWER) == F.col("text"))
            .select(F.col("digest").alias("text"), (F.col("at") - F.col("offset")).alias("begin"), "n", "window")
            .distinct()
        )
    return stage(found, "window-hits"), named.select("item_id", "window")


def _hit_words(hits: DataFrame) -> DataFrame:
    """``text`` and ``n_hit``: the words inside any occurrence, each counted once."""
    so_far = Window.partitionBy("text").orderBy("begin", "n").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("begin") + F.col("n")
    covered = F.coalesce(F.max(end).over(so_far), F.lit(0))
    fresh = F.greatest(end - F.greatest("begin", covered), F.lit(0))
    return hits.select("text", fresh.alias("fresh")).groupBy("text").agg(F.sum("fresh").cast("bigint").alias("n_hit"))


def contamination(
    docs: DataFrame, items: DataFrame, window: int = WINDOW_WORDS, shingle_words: int = SHINGLE_WORDS,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """``doc_id, n_words, n_hit, item_ids`` (as strings, in order) and ``contaminated`` for every document."""
    hits, named = window_hits(docs, items, window, shingle_words, broadcast_rows)
    held = (
        hits.select("text", "window").distinct()
        .join(_hinted(named, _small(named, broadcast_rows)), "window")
        .where("item_id IS NOT NULL")
        .select("text", F.col("item_id").cast("string").alias("item_id"))
        .distinct()
        .groupBy("text").agg(F.sort_array(F.collect_list("item_id")).alias("item_ids"))
    )
    judged = stage(_hit_words(hits).join(held, "text", "left"), "hit-texts")
    sized = docs.select(
        "doc_id",
        F.size(words_of(F.col("text"))).cast("bigint").alias("n_words"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("text"),
    )
    n_hit = F.coalesce("n_hit", F.lit(0).cast("bigint"))
    return sized.join(_hinted(judged, _small(judged, broadcast_rows)), "text", "left").select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
        (n_hit > 0).alias("contaminated"),
    )
