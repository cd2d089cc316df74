"""From text to counted terms: accents, tokens, n-grams, term frequencies.

Folding and tokens are JVM expressions; pairs of tokens and counts are Arrow steps over many rows at once. All
are row-local, so counting the terms of a document needs no shuffle.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

# Fixed value: a term starts with a letter and has three or more characters.
# (?U) makes the word boundary a Unicode one, so "straße" yields no token.
TOKEN = r"(?U)\b[a-zA-Z][a-zA-Z0-9\-]{2,}\b"

_LATIN = (*range(0x00C0, 0x0250), *range(0x0300, 0x0370), *range(0x1E00, 0x1F00))


def _bare(text: str) -> str:
    """Compatibility-decompose and drop the combining marks."""
    return "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c))


# Terms are counted for so many tokens at a time.
TOKENS_AT_ONCE = 1 << 18


@lru_cache(maxsize=1)
def _marks() -> str:
    """Pattern of the characters that combine with the one before them."""
    return "[" + "".join(rf"\x{{{a:x}}}-\x{{{b:x}}}" for a, b in _runs(c for c in range(0x300, 0x20000) if unicodedata.combining(chr(c)))) + "]"


def _runs(codes) -> list[list[int]]:
    """Ascending numbers as runs of neighbours (first, last)."""
    runs: list[list[int]] = []
    for code in codes:
        if runs and runs[-1][1] == code - 1:
            runs[-1][1] = code
        else:
            runs.append([code, code])
    return runs


@lru_cache(maxsize=1)
def _accent_rules() -> tuple[str, str, str]:
    """Source and target of ``translate``, and the class of characters it cannot settle.

    Latin letters with marks, and the marks themselves, map to one or no character,
    which ``translate`` does in the JVM. Anything else that is not ASCII may decompose.
    """
    bare = {chr(code): _bare(chr(code)) for code in _LATIN}
    settled = [c for c in bare if len(bare[c]) < 2]
    kept = [c for c in settled if bare[c] not in ("", c)]
    dropped = [c for c in settled if bare[c] == ""]
    safe = "".join(rf"\x{{{a:x}}}-\x{{{b:x}}}" for a, b in _runs(map(ord, settled)))
    return "".join(kept + dropped), "".join(bare[c] for c in kept), rf"[^\x00-\x7f{safe}]"


@F.arrow_udf(StringType())
def _bare_udf(texts: pa.Array) -> pa.Array:
    if texts.null_count == len(texts):
        return texts.cast(pa.string())
    return pc.replace_substring_regex(pc.utf8_normalize(texts.cast(pa.string()), "NFKD"), _marks(), "")


def with_folded(df: DataFrame, text: str, out: str) -> DataFrame:
    """Add ``out``: ``text`` in lower case and without accents.

    ASCII rows need the lower-casing only. Of the others, just the rows with a
    character that ``translate`` cannot settle (ligatures, full-width letters, other
    scripts) travel to Python; the UDF receives null for the rest.

    Each step is its own projection: used several times, it is still computed once.
    """
    source, target, unsettled = _accent_rules()
    low, latin = F.col("_low"), F.col("_latin")
    return (
        df.withColumn("_low", F.lower(text))
        .withColumn(
            "_latin",
            F.when(F.octet_length(low) == F.length(low), low).otherwise(
                F.translate(low, source, target)
            ),
        )
        .withColumn(
            "_rare",
            F.when((F.octet_length(latin) != F.length(latin)) & latin.rlike(unsettled), latin),
        )
        .withColumn(out, F.coalesce(_bare_udf("_rare"), latin))
        .drop("_low", "_latin", "_rare")
    )


def with_tokens(df: DataFrame, text: str, out: str = "tokens") -> DataFrame:
    """Add ``out``: the tokens of ``text``, in order."""
    found = F.regexp_extract_all("_folded", F.lit(TOKEN), F.lit(0))
    return with_folded(df, text, "_folded").withColumn(out, found).drop("_folded")


# Texts of these characters alone are plain: they are cut into tokens in Python. The capital dotted I has a lower case of two characters.
_PLAIN = [*range(0x80), *(c for c in range(0xC0, 0x180) if len(_bare(chr(c))) == 1 and c != 0x130)]

# Kinds of folded characters: those a token may have, and among them letters; those that words have.
_IN_TOKEN, _LETTER, _IN_WORD = 1, 2, 4


@F.arrow_udf(StringType())
def _odd_udf(texts: pa.Array) -> pa.Array:
    texts = texts.cast(pa.string())
    odd = [np.zeros(0, bool), *(_odd(texts.slice(lo, hi - lo)) for lo, hi in _byte_slices(texts))]
    return texts.take(pa.array(np.arange(len(texts)), mask=~np.concatenate(odd)))


def _odd(texts: pa.Array) -> np.ndarray:
    """Whether each text has other than plain characters, or broken ones."""
    raw, ends = _lines(texts)
    allowed = np.zeros(0x180, bool)
    allowed[_PLAIN] = True
    # Each byte of a wide character is the first or the second of a pair; lines end with a narrow one.
    at = np.flatnonzero(raw >= 0x80)
    first = np.where(raw[at] & 0xC0 == 0x80, at - 1, at)
    lead, second = raw[first], raw[first + 1]
    code = np.where((lead >= 0xC3) & (lead <= 0xC5), (lead & 0x1F).astype(np.int64) << 6 | second & 0x3F, 0x80)
    bad = at[(second & 0xC0 != 0x80) | ~allowed[code]]
    odd = np.zeros(len(texts), bool)
    odd[np.searchsorted(ends, bad, side="right")] = True
    return odd


def _lines(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of texts, a line end after each, and where the next begins."""
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(0, np.int64)
    _, offsets, data = pc.binary_join_element_wise(pc.fill_null(texts, ""), "", "\n").buffers()
    ends = np.frombuffer(offsets, np.int32)[1 : len(texts) + 1].astype(np.int64)
    return np.frombuffer(data, np.uint8)[: ends[-1]], ends


def with_odd_tokens(df: DataFrame, text: str, out: str) -> DataFrame:
    """Add ``out``: the tokens of texts with other than plain characters, null for the rest, which ``tokens_of`` cuts itself."""
    return with_tokens(df.withColumn("_odd", _odd_udf(text)), "_odd", out).drop("_odd")


def _folding() -> tuple[np.ndarray, np.ndarray]:
    """The folded form of each character to U+017F, and the kinds of folded ones.

    Characters that keep no ASCII form become 0x80 if they belong to words, else blanks.
    """
    folded, kinds = np.full(0x180, 0x20, np.uint8), np.zeros(256, np.uint8)
    for code in _PLAIN:
        bare = _bare(chr(code).lower()) if code >= 0x80 else chr(code).lower()
        folded[code] = ord(bare) if ord(bare) < 0x80 else 0x80 if bare.isalpha() else 0x20
    kinds[ord("a") : ord("z") + 1] = _IN_TOKEN | _LETTER | _IN_WORD
    kinds[ord("0") : ord("9") + 1] = _IN_TOKEN | _IN_WORD
    kinds[ord("-")], kinds[ord("_")], kinds[0x80] = _IN_TOKEN, _IN_WORD, _IN_WORD
    return folded, kinds


def tokens_of(texts: pa.Array, odd: pa.Array) -> pa.ListArray:
    """The tokens of each text: ``odd`` where it has some, else cut here from a plain text.

    A run of characters that tokens may have holds one token at most, as ``TOKEN`` takes all it can: from the
    run's first letter that begins a word, to its last boundary of words.
    """
    folded, kinds = _folding()
    texts = texts.cast(pa.string())
    raw, ends = _lines(texts.take(pa.array(np.arange(len(texts)), mask=odd.is_valid().to_numpy(zero_copy_only=False))))
    wide = raw >= 0x80
    if wide.any():
        # Of the two bytes of a character the first is kept, and becomes its folded form.
        second = np.flatnonzero(raw & 0xC0 == 0x80)
        first = second - 1
        chars = folded[np.where(wide, 0x20, raw)]
        chars[first] = folded[(raw[first] & 0x1F).astype(np.int64) << 6 | raw[second] & 0x3F]
        chars = np.delete(chars, second)
        ends = ends - np.searchsorted(second, ends)
    else:
        chars = folded[raw]
    kind = kinds[chars]
    word = np.concatenate([[False], kind & _IN_WORD > 0, [False]])
    border = np.flatnonzero(word[1:] != word[:-1])
    inside = np.concatenate([[False], kind & _IN_TOKEN > 0, [False]])
    run = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = run[::2], run[1::2]
    first = border[border < len(kind)]
    first = np.append(first[kind[first] & _LETTER > 0], len(kind) + 3)
    start = first[np.searchsorted(first, start)]
    # Every run ends before a line's end, so a border precedes each run that has a letter.
    last = np.append(border, -1)[np.searchsorted(border, end, side="right") - 1]
    found = (start < end) & (last - start >= 3)
    start, last = start[found], last[found]
    row = np.searchsorted(ends, start, side="right")
    edges = np.zeros(len(kind) + 1, np.int8)
    edges[start] += 1
    edges[last] -= 1
    letters = chars[np.cumsum(edges[:-1], dtype=np.int8) > 0]
    places = np.concatenate([[0], np.cumsum(last - start)]).astype(np.int32)
    tokens = pa.StringArray.from_buffers(len(start), pa.py_buffer(places), pa.py_buffer(letters))
    if odd.null_count < len(odd):
        row = np.concatenate([row, np.repeat(np.arange(len(odd)), pc.fill_null(pc.list_value_length(odd), 0).to_numpy())])
        order = np.argsort(row, kind="stable")
        tokens = pa.concat_arrays([tokens, odd.flatten().cast(pa.string())]).take(pa.array(order))
    sizes = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(texts)))]).astype(np.int32)
    return pa.ListArray.from_arrays(sizes, tokens)


def text_slices(texts: pa.Array, odd: pa.Array) -> Iterator[tuple[int, pa.ListArray]]:
    """First rows and tokens of parts of some ``TOKENS_AT_ONCE`` tokens, taken for eight bytes each; one row at least."""
    for lo, hi in _byte_slices(texts):
        yield lo, tokens_of(texts.slice(lo, hi - lo), odd.slice(lo, hi - lo))


def _byte_slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy().astype(np.int64))
    lo = 0
    while lo < len(texts):
        done = ends[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, done + 8 * TOKENS_AT_ONCE, side="right")))
        yield lo, hi
        lo = hi


def terms_of(tokens: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, pa.Array]:
    """All terms of rows of tokens, and the row of each: the tokens, then blank-joined neighbouring tokens.

    A pair bridges whatever the token pattern skipped between its two tokens.
    """
    if isinstance(tokens, pa.ChunkedArray):
        tokens = tokens.combine_chunks()
    sizes = pc.fill_null(pc.list_value_length(tokens), 0).to_numpy()
    row, flat = np.repeat(np.arange(len(tokens)), sizes), tokens.flatten()
    first = np.flatnonzero(row[1:] == row[:-1])
    pairs = pc.binary_join_element_wise(flat.take(pa.array(first)), flat.take(pa.array(first + 1)), " ")
    return np.concatenate([row, row[first]]), pa.concat_arrays([flat, pairs])


@F.arrow_udf(ArrayType(StringType()))
def _terms_udf(tokens: pa.Array) -> pa.Array:
    row, terms = terms_of(tokens)
    order = np.argsort(row, kind="stable")
    offsets = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(tokens)))]).astype(np.int32)
    return pa.ListArray.from_arrays(offsets, terms.take(pa.array(order)))


def with_terms(df: DataFrame, text: str, out: str = "terms") -> DataFrame:
    """Add ``out``: the terms of ``text`` as an array, tokens first."""
    return with_tokens(df, text, "_tokens").withColumn(out, _terms_udf("_tokens")).drop("_tokens")


def row_slices(tokens: pa.Array) -> Iterator[tuple[int, int]]:
    """First and past-last rows of parts with about ``TOKENS_AT_ONCE`` tokens, one row at least."""
    ends = np.cumsum(pc.fill_null(pc.list_value_length(tokens), 0).to_numpy())
    lo = 0
    while lo < len(tokens):
        done = ends[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, done + TOKENS_AT_ONCE, side="right")))
        yield lo, hi
        lo = hi


def coded_terms(tokens: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """The row of each term, as ``terms_of`` finds them, and its place in the distinct terms; these terms.

    Only distinct pairs become text.
    """
    sizes = pc.fill_null(pc.list_value_length(tokens), 0).to_numpy()
    row, words = np.repeat(np.arange(len(tokens)), sizes), tokens.flatten().dictionary_encode()
    code, words = words.indices.to_numpy().astype(np.int64), words.dictionary
    first, n = np.flatnonzero(row[1:] == row[:-1]), max(len(words), 1)
    pairs = pa.array(code[first] * n + code[first + 1]).dictionary_encode()
    pair = pairs.dictionary.to_numpy()
    names = pc.binary_join_element_wise(words.take(pa.array(pair // n)), words.take(pa.array(pair % n)), " ")
    places = np.concatenate([code, len(words) + pairs.indices.to_numpy().astype(np.int64)])
    return np.concatenate([row, row[first]]), places, pa.concat_arrays([words, names])


def _counted(tokens: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """Rows, places in the distinct terms, and numbers of each row's terms; the distinct terms."""
    row, place, names = coded_terms(tokens)
    n = max(len(names), 1)
    cell, tf = np.unique(row * n + place, return_counts=True)
    return cell // n, cell % n, tf, names


def term_counts(df: DataFrame, text: str, key: str) -> DataFrame:
    """``(key, term, tf)``; no row leaves its partition."""
    rows = with_odd_tokens(df.select(key, F.col(text).alias("_text")), "_text", "_tokens").select(key, "_text", "_tokens")
    out = StructType([rows.schema[key], StructField("term", StringType()), StructField("tf", IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, tokens in text_slices(batch.column(1), batch.column(2)):
                row, term, tf, names = _counted(tokens)
                columns = [batch.column(0).take(pa.array(lo + row)), names.take(pa.array(term)), pa.array(tf, pa.int32())]
                yield pa.RecordBatch.from_arrays(columns, out.names)

    return rows.mapInArrow(run, out)


def term_totals(df: DataFrame, text: str) -> DataFrame:
    """``(term, df, total)``: in how many rows and how often each term occurs.

    Terms are counted for many rows at a time before they are shuffled.
    """
    rows = with_odd_tokens(df.select(text), text, "_tokens").select(text, "_tokens")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, tokens in text_slices(batch.column(0), batch.column(1)):
                row, place, names = coded_terms(tokens)
                n = len(names)
                cells = pc.unique(pa.array(row * n + place)).to_numpy()
                often = [np.bincount(cells % max(n, 1), minlength=n), np.bincount(place, minlength=n)]
                yield pa.RecordBatch.from_arrays([names, *map(pa.array, often)], ["term", "df", "total"])

    partial = rows.mapInArrow(run, "term string, df long, total long")
    return partial.groupBy("term").agg(F.sum("df").alias("df"), F.sum("total").alias("total"))
