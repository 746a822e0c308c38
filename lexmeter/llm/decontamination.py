"""Benchmark decontamination: Wu-Manber search for benchmark windows in documents.

A benchmark item gives its windows of ten words, or itself if it is shorter. All
windows are searched at once. For a block of bytes, a shift table tells how far the
search may skip because no window can end there; where it may not skip, the block picks
a bucket of test strings, and a direct comparison of bytes confirms an occurrence. A
batch of texts is cut into lanes that advance side by side, one array step at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmeter.llm.common import LOWER, UPPER, fresh
from lexmeter.sources.scratch import new_folder, written

WINDOW = 10
#: Test strings loaded at once, in bytes; a larger benchmark is searched in several passes.
TABLE_BYTES = 32 * 2**20
#: Bytes of text a lane covers, and bytes of text searched at once.
LANE = 4096
BATCH = 8 * 2**20

# Fixed values.
ITEM_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORD_BYTES = b"0123456789abcdefghijklmnopqrstuvwxyz"

_PAD = 8
_MIX = np.uint64(0x9E3779B97F4A7C15)
_FOUND = "struct<n_words:bigint,hits:array<int>,items:array<string>>"
_ARROW = pa.struct(
    [("n_words", pa.int64()), ("hits", pa.list_(pa.int32())), ("items", pa.list_(pa.string()))]
)


def _byte_table() -> bytes:
    """Maps each byte to itself in a word, A-Z to a-z, and all others to a space."""
    table = bytearray(b" " * 128 + bytes(range(128, 256)))
    for byte in WORD_BYTES:
        table[byte] = byte
        table[ord(chr(byte).upper())] = byte
    return bytes(table)


TABLE = _byte_table()


def _blocks(buffer: np.ndarray, ends: np.ndarray, width: int) -> np.ndarray:
    """The ``width`` <= 8 bytes that end at each position, as numbers."""
    words = np.ndarray(len(buffer) - 7, "<u8", buffer, strides=(1,))
    return words[ends - 7] >> np.uint64(64 - 8 * width)


class Matcher:
    """Shift table and test strings of byte patterns that have at least ``shortest`` bytes."""

    def __init__(self, patterns: list[bytes], numbers: list[int]):
        self.shortest = min(map(len, patterns))
        self.width = min(self.shortest, 8)
        reach = self.shortest - self.width + 1
        heads = b"".join(b"\0" * _PAD + p[: self.shortest] for p in patterns)
        buffer = np.frombuffer(heads, np.uint8)
        last = np.arange(1, len(patterns) + 1) * (_PAD + self.shortest) - 1
        size = max(12, min(22, int(len(patterns) * reach).bit_length() + 4))
        self.down = np.uint64(64 - size)
        self.shift = np.full(1 << size, reach, np.int64)
        for back in range(reach - 1, -1, -1):
            self.shift[self._slot(_blocks(buffer, last - back, self.width))] = back
        suffixes = _blocks(buffer, last, self.width)
        starts = last - self.shortest + self.width
        self.prefixes = np.unique(_blocks(buffer, starts, self.width))
        self.tests: dict[int, dict[int, dict[bytes, int]]] = {}
        for suffix, pattern, number in zip(suffixes.tolist(), patterns, numbers, strict=True):
            by_length = self.tests.setdefault(suffix, {})
            by_length.setdefault(len(pattern), {})[pattern] = number

    def _slot(self, blocks: np.ndarray) -> np.ndarray:
        return (blocks * _MIX) >> self.down

    def search(self, data: bytes, buffer: np.ndarray) -> Iterator[tuple[int, int]]:
        """Start and pattern number of every occurrence; ``buffer`` is padded at the front."""
        first = _PAD + self.shortest - 1
        ends = np.arange(first, len(buffer), LANE)
        limits = np.minimum(ends + LANE, len(buffer))
        stopped = []
        while len(ends):
            step = self.shift[self._slot(_blocks(buffer, ends, self.width))]
            stopped.append(ends[step == 0])
            ends = ends + np.maximum(step, 1)
            inside = ends < limits
            ends, limits = ends[inside], limits[inside]
        if not stopped:
            return
        at = np.concatenate(stopped)
        prefix = _blocks(buffer, at - self.shortest + self.width, self.width)
        place = np.minimum(np.searchsorted(self.prefixes, prefix), len(self.prefixes) - 1)
        at = at[self.prefixes[place] == prefix]
        suffixes = _blocks(buffer, at, self.width)
        for end, suffix in zip(at.tolist(), suffixes.tolist(), strict=True):
            start = end - self.shortest + 1 - _PAD
            for length, strings in self.tests.get(suffix, {}).items():
                number = strings.get(data[start : start + length])
                if number is not None:
                    yield start, number


class Windows:
    """All windows of a benchmark, each with the ids of its items."""

    def __init__(self, rows: list[tuple[str, list[str]]]):
        self.items = [items for _, items in rows]
        self.words = [window.count(" ") + 1 for window, _ in rows]
        patterns = [b" %b " % window.encode() for window, _ in rows]
        # Short windows have a search of their own, as the shortest bounds every skip.
        classes: dict[int, list[int]] = {}
        for number, pattern in enumerate(patterns):
            classes.setdefault(min(len(pattern).bit_length(), 5), []).append(number)
        self.matchers = [
            Matcher([patterns[n] for n in numbers], numbers) for numbers in classes.values()
        ]

    def scan(self, texts: list[bytes]) -> Iterator[tuple[int, np.ndarray, set[str]]]:
        """Number of words, positions of hit words and ids of items found, for each text."""
        words = [text.translate(TABLE).split() for text in texts]
        # Each text has its own space on either side: no window spans two texts.
        plain = [b" %b " % b" ".join(w) if w else b"" for w in words]
        data = b"".join(plain)
        buffer = np.frombuffer(b"\0" * _PAD + data, np.uint8)
        starts = np.cumsum([0] + [len(p) for p in plain])
        found: dict[int, list[tuple[int, int]]] = {}
        for matcher in self.matchers:
            hits = list(matcher.search(data, buffer))
            owners = np.searchsorted(starts, [start for start, _ in hits], "right") - 1
            for owner, hit in zip(owners.tolist(), hits, strict=True):
                found.setdefault(owner, []).append(hit)
        for i, own in enumerate(words):
            hit, items = np.zeros(len(own), bool), set()
            if i in found:
                gaps = np.flatnonzero(buffer[_PAD + starts[i] : _PAD + starts[i + 1]] == 32)
                for start, number in found[i]:
                    word = int(np.searchsorted(gaps, start - starts[i]))
                    hit[word : word + self.words[number]] = True
                    items.update(self.items[number])
            yield len(own), np.flatnonzero(hit).astype(np.int32), items


def _parts(texts: pa.Array) -> Iterator[list[bytes]]:
    """Texts of an Arrow batch in lists of bounded size; a long text is alone in its list."""
    part, size = [], 0
    for value in texts:
        text = (value.as_py() or "").encode()
        if part and size + len(text) > BATCH:
            yield part
            part, size = [], 0
        part.append(text)
        size += len(text)
    yield part


def _scanner(spark: SparkSession, rows: list[tuple[str, list[str]]]):
    """An Arrow function from texts to what is found in them."""
    shared = spark.sparkContext.broadcast(rows)

    @F.arrow_udf(_FOUND)
    def scan(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        windows = Windows(shared.value)
        for batch in batches:
            counts, hits, items = [], [], []
            for part in _parts(batch):
                for n, hit, ids in windows.scan(part):
                    counts.append(n)
                    hits.append(hit)
                    items.append(sorted(ids))
            yield pa.StructArray.from_arrays(
                [
                    pa.array(counts, pa.int64()),
                    pa.array(hits, pa.list_(pa.int32())),
                    pa.array(items, pa.list_(pa.string())),
                ],
                fields=list(_ARROW),
            )

    return scan


def item_words(text: Column) -> Column:
    """Words by the rule of the search: runs of digits, letters and all beyond ASCII."""
    lowered = F.translate(text, UPPER, LOWER)
    return F.regexp_extract_all(lowered, F.lit(f"({ITEM_WORD})"), F.lit(0))


def item_windows(
    benchmark: DataFrame, item: str = "item_id", text: str = "text", words: int = WINDOW
) -> DataFrame:
    """Distinct windows with the ids, as strings, of the items that hold them."""
    split = benchmark.select(F.col(item).cast("string").alias("item"), item_words(F.col(text)).alias("w"))
    last = F.greatest(F.size("w") - words, F.lit(0))
    windows = F.transform(
        F.sequence(F.lit(0), last), lambda i: F.array_join(F.slice("w", i + 1, words), " ")
    )
    rows = split.where(F.size("w") > 0).select("item", F.explode(windows).alias("window"))
    return rows.groupBy("window").agg(F.collect_set("item").alias("items"))


def find_benchmark(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    words: int = WINDOW,
    table_bytes: int = TABLE_BYTES,
) -> DataFrame:
    """Add ``n_words``, ``hits`` and ``items``: words, positions of hit words, items found.

    NULL, empty and blank texts have no words and no hits; an item without words has no
    window; a window of an item without id marks words but names no item; repeated
    items count once. Columns of ``docs`` with the added names are replaced. The windows
    are passed to the tasks in tables of at most ``table_bytes``; where there are more,
    the texts are searched once for each table.
    """
    spark = docs.sparkSession
    folder = new_folder(spark)
    windows = written(item_windows(benchmark, item, item_text, words), f"{folder}/windows")
    weight = F.octet_length("window") + 64 + 24 * F.size("items")
    tables = int((windows.agg(F.sum(weight)).first()[0] or 0) // table_bytes) + 1
    columns = [c for c in docs.columns if c.lower() not in ("n_words", "hits", "items")]
    scan, total = (fresh(docs.columns, name) for name in ("_scan", "_total"))
    found = docs.select(*columns, *([] if text in columns else [text]))
    for table in range(tables):
        part = windows.where(F.pmod(F.xxhash64("window"), F.lit(tables)) == table)
        rows = [(row.window, row["items"]) for row in part.collect()]
        found = found.withColumn(scan, _scanner(spark, rows)(F.col(text)))
        if table:
            merged = F.struct(
                F.col(f"{scan}.n_words"),
                F.array_union(f"{total}.hits", f"{scan}.hits").alias("hits"),
                F.array_union(f"{total}.items", f"{scan}.items").alias("items"),
            )
            found = found.withColumn(total, merged).drop(scan)
        else:
            found = found.withColumnRenamed(scan, total)
        if table < tables - 1:
            found = written(found, f"{folder}/pass{table}")
    return found.select(*columns, f"{total}.n_words", f"{total}.hits", f"{total}.items")


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hit words and items of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = find_benchmark(docs, benchmark)
    names = F.array_join(F.array_sort("items"), ",")
    return found.select(
        "doc_id",
        "n_words",
        F.size("hits").cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(names, 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
    )


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The documents, with all their columns, that hold no window of the benchmark."""
    held = docs.select(F.col(text).alias("text"), F.struct(*docs.columns).alias("row"))
    found = find_benchmark(held, benchmark)
    return found.where(F.size("hits") == 0).select("row.*")


OP8_SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id,
    regexp_extract_all(translate(coalesce("text", ''), '{UPPER}', '{LOWER}'), '{ITEM_WORD}') AS w
  FROM documents
), b AS (
  SELECT CAST(item_id AS VARCHAR) AS item,
    regexp_extract_all(translate("text", '{UPPER}', '{LOWER}'), '{ITEM_WORD}') AS w
  FROM benchmark
), bw AS (
  SELECT DISTINCT item, least(len(w), {WINDOW}) AS n,
    array_to_string(w[i : i + {WINDOW - 1}], ' ') AS win
  FROM (SELECT item, w, unnest(generate_series(1, greatest(len(w) - {WINDOW - 1}, 1))) AS i
        FROM b WHERE len(w) > 0)
), dw AS (
  SELECT rid, i, n, array_to_string(w[i : i + n - 1], ' ') AS win
  FROM (SELECT rid, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i
        FROM d, (SELECT DISTINCT n FROM bw) WHERE len(w) >= n)
), hit AS (
  SELECT rid, i, n, item FROM dw JOIN bw USING (n, win)
), spots AS (
  SELECT rid, count(DISTINCT spot) AS n_hit
  FROM (SELECT rid, unnest(generate_series(i, i + n - 1)) AS spot FROM hit) GROUP BY rid
), found AS (
  SELECT rid, count(DISTINCT item) AS n_items,
    string_agg(DISTINCT item, ',' ORDER BY item) AS names
  FROM hit GROUP BY rid
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN spots USING (rid) LEFT JOIN found USING (rid)
"""
