"""Benchmark decontamination: Wu-Manber multi-pattern search over words.

Every window of ten consecutive words of a benchmark item is a pattern. A block of two words
indexes a shift table: how far the search may jump ahead because no pattern has that block
nearer to its end. Where the shift is zero, the block's bucket names the patterns that end in
it, and direct comparison of the words confirms them. Most blocks of a document occur in no
pattern at all, so the search looks at about one word in nine. Documents are searched row by
row; only patterns travel. Items are read in blocks of bounded size, one pass over the rows for
each block, so the broadcast tables stay bounded however large the benchmark is.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textorbit.llm.common import append_columns, table, without

WINDOW = 10
# Patterns of one pass come from items of at most so many bytes of text together.
BLOCK_BYTES = 16 << 20

# Bytes of words are digits, letters and everything beyond ASCII; A-Z become a-z.
_TABLE = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_TABLE).split()


class WuManber:
    """Search tables for patterns of one length, given as tuples of word numbers."""

    def __init__(self, patterns: dict[tuple[int, ...], list[int]], length: int):
        self.length, self.patterns = length, patterns
        self.block = min(2, length)
        self.skip = length - self.block + 1
        self.shift: dict[int, int] = {}
        self.buckets: dict[int, dict[tuple[int, ...], list[int]]] = {}
        for pattern, items in patterns.items():
            for end in range(self.block, length + 1):
                key = self.key(pattern[end - 2] if self.block == 2 else 0, pattern[end - 1])
                self.shift[key] = min(self.shift.get(key, self.skip), length - end)
            self.buckets.setdefault(key, {})[pattern] = items

    @staticmethod
    def key(first: int, second: int) -> int:
        return first << 32 | second

    def search(self, ids: list[int]) -> Iterator[tuple[int, list[int]]]:
        """Start of each occurrence and the items that have it."""
        n, m, skip, shift, pair = len(ids), self.length, self.skip, self.shift, self.block == 2
        at = m - 1
        while at < n:
            key = ids[at - 1] << 32 | ids[at] if pair else ids[at]
            jump = shift.get(key, skip)
            if jump:
                at += jump
                continue
            start = at - m + 1
            items = self.buckets[key].get(tuple(ids[start : at + 1]))
            if items is not None:
                yield start, items
            at += 1


class Patterns:
    """Search tables of a block of items: one per length, as items of few words are one window."""

    def __init__(self, items: list[tuple[str, str | None]], window: int):
        self.vocabulary: dict[bytes, int] = {}
        self.names: list[str] = []
        by_length: dict[int, dict[tuple[int, ...], list[int]]] = {}
        for name, text in items:
            words = words_of(text)
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words]
            if not ids:
                continue
            number = len(self.names)
            self.names.append(name)
            length = min(window, len(ids))
            for start in range(len(ids) - length + 1):
                found = by_length.setdefault(length, {}).setdefault(tuple(ids[start : start + length]), [])
                if not found or found[-1] != number:
                    found.append(number)
        self.searches = [WuManber(patterns, length) for length, patterns in sorted(by_length.items())]

    def find(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Merged spans of hit words and the names of items that occur."""
        get = self.vocabulary.get
        ids = [get(w, 0) for w in words]
        spans, items = [], set()
        for search in self.searches:
            for start, numbers in search.search(ids):
                spans.append((start, start + search.length))
                items.update(numbers)
        return merged(spans), {self.names[i] for i in items}


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((start, end))
    return out


def item_blocks(benchmark: DataFrame, block_bytes: int) -> Iterator[list[tuple[str, str]]]:
    """Items by blocks of at most ``block_bytes`` of text (one item at least).

    One block is on the driver at a time.
    """
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text")
    items = items.filter("item_id IS NOT NULL AND text IS NOT NULL")
    block, size = [], 0
    for row in items.toLocalIterator():
        bytes_ = len(row.text.encode("utf-8", "surrogatepass"))
        if block and size + bytes_ > block_bytes:
            yield block
            block, size = [], 0
        block.append((row.item_id, row.text))
        size += bytes_
    if block:
        yield block


RESULT = "n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"


def find_benchmark(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """Append ``hit_spans`` (starts and ends of hit words), ``items`` and their digest to ``docs``.

    Texts that are null or empty have no words and no hits. Items that are null, without
    words, or without a name match nothing; items that repeat a name count once; equal items
    of different names all count. Without items, nothing is hit; an empty table of documents
    stays empty. Long texts are searched whole. Other columns are carried along, and columns
    named like a result are replaced by it.
    """
    spark = docs.sparkSession
    names = [f.split()[0] for f in RESULT.split(", ")] + ["hit_spans", "items"]
    keep = without(docs, names)
    found = docs.select(*[F.col(f"`{c}`") for c in keep], F.lit(None).cast("array<array<int>>").alias("hit_spans"),
                        F.lit(None).cast("array<string>").alias("items"))
    for block in item_blocks(benchmark, block_bytes):
        shared = spark.sparkContext.broadcast((block, window))
        cache: list[Patterns] = []

        def search(texts, spans, items, shared=shared, cache=cache):
            if not cache:
                cache.append(Patterns(*shared.value))
            out_spans, out_items = [], []
            for text, old_spans, old_items in zip(texts, spans, items):
                new_spans, new_items = cache[0].find(words_of(text))
                out_spans.append(merged([*map(tuple, old_spans or ()), *new_spans]))
                out_items.append(sorted(new_items.union(old_items or ())))
            return [out_spans, out_items]

        found = append_columns(found, ["text", "hit_spans", "items"], "hit_spans array<array<int>>, items array<string>", search)

    def digest(texts, spans, items):
        rows = []
        for text, span, names in zip(texts, spans, items):
            hit = sum(end - start for start, end in span or ())
            joined = ",".join(sorted(names or ()))
            sha = hashlib.sha256(joined.encode()).hexdigest()
            rows.append((len(words_of(text)), hit, len(names or ()), sha, hit > 0))
        return [list(c) for c in zip(*rows)] if rows else [[] for _ in range(5)]

    return append_columns(found, ["text", "hit_spans", "items"], RESULT, digest)


def op9_wu_manber(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_benchmark(docs, table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


_WORDS = (
    "string_split_regex(trim(regexp_replace(translate({t}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),"
    " '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+', ' ', 'g')), ' +')"
)


def _word_list(text: str) -> str:
    return f"list_filter({_WORDS.format(t=f'coalesce({text}, chr(32))')}, lambda w: w <> '')"


OP9_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_word_list('text')} AS w FROM documents),
b AS (SELECT DISTINCT CAST(item_id AS VARCHAR) AS item_id, {_word_list('text')} AS w FROM benchmark WHERE item_id IS NOT NULL),
p AS (
    SELECT DISTINCT item_id, least(len(w), {WINDOW}) AS m, array_to_string(w[i:i + least(len(w), {WINDOW}) - 1], ' ') AS pat
    FROM (SELECT *, unnest(range(1, len(w) - least(len(w), {WINDOW}) + 2)) AS i FROM b WHERE len(w) > 0)
),
m AS (SELECT DISTINCT m FROM p),
v AS (
    SELECT rid, i, m, array_to_string(w[i:i + m - 1], ' ') AS pat
    FROM (SELECT rid, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM d, m WHERE len(w) >= m)
),
h AS (SELECT rid, i, v.m, item_id FROM v JOIN p ON v.m = p.m AND v.pat = p.pat),
k AS (SELECT rid, count(DISTINCT pos) AS n_hit FROM (SELECT rid, unnest(range(i, i + m)) AS pos FROM h) GROUP BY rid),
s AS (
    SELECT rid, count(*) AS n_items, sha256(string_agg(item_id, ',' ORDER BY item_id)) AS sha
    FROM (SELECT DISTINCT rid, item_id FROM h) GROUP BY rid
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       coalesce(sha, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN k USING (rid) LEFT JOIN s USING (rid)
"""

QUERIES = {"op9_wu_manber": op9_wu_manber}
ORACLES = {"op9_wu_manber": OP9_SQL}
