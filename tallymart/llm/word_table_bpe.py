"""Byte-level BPE of whole texts through a table of distinct words.

Encoding: Spark splits texts into words, an occurrence list per block of rows keeps the words as codes, every distinct
word is encoded once for the whole corpus, and its ids go back to the blocks and there to the positions of the word.
Decoding: every id is joined with its piece; the pieces of a text are put together and read as UTF-8.

A word ends before a space that stands between two characters that are no white space. The tokenizer never joins
characters across such a place, so the ids of a text are those of its words, one after another. Runs of white space
stay inside a word; a text without such spaces is one word.

Defined results: a null or empty text has no ids and decodes to an empty text. Equal rows give equal rows, null ids stay.
An empty table gives an empty one. Only the id and the ids (or the text) come back: other columns, whatever their names,
are left out. Very long texts are encoded whole; a worker holds one block (BLOCK_BYTES of text, or one Arrow batch).
Ties cannot occur.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymart.llm.rows import as_scan
from tallymart.session import write_through

#: Text of a block: the words of a block travel once, whatever their number of occurrences.
BLOCK_BYTES = 32 << 20
#: Occurrences that are put together at a time.
TAKE = 500_000
#: Encoded words that are sorted by block before they travel on.
HELD = 250_000
# The characters with the Unicode property White_Space.
WHITE_SPACE = r"\x09-\x0D\x20\x85\xA0  -     　"
# Most neighbours are printable ASCII, which is tried first.
_SOLID = rf"(?:[!-~]|[^{WHITE_SPACE}])"
IDS = T.StructField("ids", T.ArrayType(T.IntegerType()))
TEXT = T.StructField("text", T.StringType())
BETWEEN_WORDS = rf" (?<={_SOLID} )(?={_SOLID})"


def split_words(text: str | Column) -> Column:
    """The words of a text; all but the first stand after one space that is not part of them here."""
    return F.split(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")), BETWEEN_WORDS)


def encode(docs: DataFrame, tokenizer: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows ``id, ids`` (array of int): the ids of the tokenizer file, without special tokens added."""
    placed = _placed(docs, tokenizer, id, text)
    return placed.mapInArrow(_place_ids, T.StructType([placed.schema["id"], IDS]))


def _placed(docs: DataFrame, tokenizer: str, id: str, text: str) -> DataFrame:
    """By blocks: the ids of the words, then the texts as codes of words."""
    scan = as_scan(docs.select(F.col(id).alias("id"), F.col(text).alias("text")))
    place = F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")
    source = scan.select("id", *place, split_words("text").alias("words"))
    kind, long = source.schema["id"], T.LongType()
    block = [T.StructField("file", long), T.StructField("row", long)]
    coded = source.mapInArrow(_text_rows, T.StructType([*block, kind, T.StructField("codes", T.BinaryType())]))
    table = (
        source.mapInArrow(_word_rows, "file long, row long, code int, word string")
        .repartition("word")
        .sortWithinPartitions("word")
        .mapInArrow(_encoder(tokenizer), "file long, row long, words binary")
    )
    both = write_through(table, "words").unionByName(coded, allowMissingColumns=True).repartition("file", "row")
    return both.sortWithinPartitions("file", "row", F.col("codes").isNotNull())


def decode(coded: DataFrame, tokenizer: str) -> DataFrame:
    """``coded`` (``id``, ``ids``) with the ``text`` of the ids.

    The piece table is bounded by the vocabulary file, so the join is made where the ids are: by position, in Arrow.
    """
    rows = coded.select("id", "ids")
    return rows.mapInArrow(_decoder(tokenizer), T.StructType([*rows.schema, TEXT]))


def recode(docs: DataFrame, tokenizer: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``decode(encode(docs))`` in one go: a task hands the ids on to their decoding without another worker."""
    placed = _placed(docs, tokenizer, id, text)
    decoder = _decoder(tokenizer)
    return placed.mapInArrow(lambda batches: decoder(_place_ids(batches)), T.StructType([placed.schema["id"], IDS, TEXT]))


def _decoder(tokenizer: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _pieces(tokenizer)
        for batch in batches:
            for part in _slices(batch, pc.fill_null(pc.list_value_length(batch.column("ids")), 0).to_numpy(zero_copy_only=False)):
                lists = part.column("ids")
                joined = pieces.take(lists.flatten())
                at = np.frombuffer(joined.buffers()[1], np.int64, len(joined) + 1) if len(joined) else np.zeros(1, np.int64)
                ends = np.concatenate(([0], np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))))
                data = memoryview(joined.buffers()[2] or b"")
                texts = [str(data[at[a] : at[b]], "utf-8", "replace") for a, b in zip(ends[:-1], ends[1:])]
                yield pa.RecordBatch.from_arrays([part.column("id"), lists, pa.array(texts, pa.string())], ["id", "ids", "text"])

    return run


def _slices(batch: pa.RecordBatch, sizes: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of about TAKE values."""
    start, total = 0, 0
    for row, size in enumerate(sizes):
        if total and total + size > TAKE:
            yield batch.slice(start, row - start)
            start, total = row, 0
        total += int(size)
    if start < len(batch):
        yield batch.slice(start)


# ---- blocks ----------------------------------------------------------------------------------


def _blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[list[pa.RecordBatch], list[np.ndarray], pa.Array, np.ndarray]]:
    """Blocks of rows: batches, number of words of each row, distinct words, code of every word. Named by the place of
    its first row in the files, a block is the same in every reading of them."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        held.append(batch)
        size += batch.column("words").nbytes
        if size >= BLOCK_BYTES:
            yield _block(held)
            size, held = 0, []
            pa.default_memory_pool().release_unused()  # workers live on through later stages
    if held:
        yield _block(held)
    pa.default_memory_pool().release_unused()


def _block(held: list[pa.RecordBatch]) -> tuple[list[pa.RecordBatch], list[np.ndarray], pa.Array, np.ndarray]:
    counts = [b.column("words").value_lengths().to_numpy(zero_copy_only=False).astype(np.int64) for b in held]
    pieces = pa.concat_arrays([b.column("words").flatten() for b in held]).dictionary_encode()
    codes = pieces.indices.to_numpy(zero_copy_only=False).astype(np.int64) * 2
    rows = np.concatenate(counts)
    starts = np.cumsum(rows) - rows
    codes[starts] += 1  # odd: the first word of a text, without a space before it
    nothing = pieces.dictionary.index("").as_py()
    empty = codes[starts] == 2 * nothing + 1 if nothing >= 0 else np.zeros(len(rows), bool)
    if empty.any():
        codes = np.delete(codes, starts[empty])
        rows = rows - empty
        counts = np.split(rows, np.cumsum([len(c) for c in counts])[:-1])
    seen = np.bincount(codes, minlength=2 * len(pieces.dictionary))
    order = np.argsort(-seen, kind="stable")[: np.count_nonzero(seen)]  # the most frequent first
    rank = np.empty(len(seen), np.uint32)
    rank[order] = np.arange(len(order), dtype=np.uint32)
    space = pc.if_else(pa.array(order % 2 == 1), "", " ")
    return held, counts, pc.binary_join_element_wise(space, pieces.dictionary.take(pa.array(order // 2)), ""), rank[codes]


def _planes(values: np.ndarray) -> np.ndarray:
    """One byte plane of 32-bit values after another: the high bytes are nearly all 0."""
    return np.ascontiguousarray(values.astype("<u4", copy=False).view(np.uint8).reshape(-1, 4).T)


def _values(planes: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(4, -1).T).view("<u4").reshape(-1)


def _name(held: list[pa.RecordBatch], rows: int) -> list[pa.Array]:
    """The name of a block, for so many rows."""
    return [pa.array(np.full(rows, held[0].column(part)[0].as_py(), np.int64)) for part in ("file", "row")]


def _word_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for held, _, distinct, _ in _blocks(batches):
        for start in range(0, len(distinct), 100_000):
            part = distinct.slice(start, 100_000)
            codes = np.arange(start, start + len(part), dtype=np.int32)
            columns = [*_name(held, len(part)), pa.array(codes), part]
            yield pa.RecordBatch.from_arrays(columns, ["file", "row", "code", "word"])


def _text_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pack = zstandard.ZstdCompressor(level=1)
    for held, counts, _, codes in _blocks(batches):
        at = 0
        for batch, lengths in zip(held, counts):
            blobs = []
            for length in lengths:
                blobs.append(pack.compress(_planes(codes[at : at + length])))
                at += length
            columns = [*_name(held, len(batch)), batch.column("id"), pa.array(blobs, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["file", "row", "id", "codes"])


def _place_ids(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a partition by block, its words first: hold the ids of the block's words, then fill in its texts."""
    unpack = zstandard.ZstdDecompressor()
    block, chunks, table = None, [], None
    for batch in batches:
        files, rows = batch.column("file").to_numpy(), batch.column("row").to_numpy()
        is_text = batch.column("codes").is_valid().to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero((np.diff(files) != 0) | (np.diff(rows) != 0) | (np.diff(is_text) != 0)) + 1
        for start, end in zip([0, *cuts], [*cuts, len(batch)]):
            part = batch.slice(start, end - start)
            if block != (files[start], rows[start]):
                block, chunks, table = (files[start], rows[start]), [], None
            if not is_text[start]:
                chunks += [_values(unpack.decompress(blob)) for blob in part.column("words").to_pylist()]
                continue
            if table is None:
                table = _id_lists(chunks)
            blobs = part.column("codes").to_pylist()
            sizes = np.array([zstandard.get_frame_parameters(blob).content_size // 4 for blob in blobs])
            for piece in _slices(part, sizes):
                mine = [_values(unpack.decompress(blob)) for blob in piece.column("codes").to_pylist()]
                lists = table.take(pa.array(np.concatenate(mine)))
                lengths = np.concatenate(([0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))))
                ends = lengths[np.concatenate(([0], np.cumsum([len(x) for x in mine])))]
                ids = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), lists.flatten())
                yield pa.RecordBatch.from_arrays([piece.column("id"), ids], ["id", "ids"])


def _id_lists(chunks: list[np.ndarray]) -> pa.ListArray:
    """The ids of the words of a block, by code. A chunk holds the number of its words, their codes, their numbers of
    ids and the ids."""
    counts = [int(c[0]) for c in chunks]
    codes, sizes, ids = (
        np.concatenate([np.zeros(0, np.uint32), *parts])
        for parts in zip(*((c[1 : n + 1], c[n + 1 : 2 * n + 1], c[2 * n + 1 :]) for c, n in zip(chunks, counts)))
    ) if chunks else (np.zeros(0, np.uint32),) * 3
    ends = np.concatenate(([0], np.cumsum(sizes, dtype=np.int64))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(ids.astype(np.int32))).take(pa.array(np.argsort(codes)))


# ---- vocabulary ------------------------------------------------------------------------------


@cache
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(path)
    found.no_truncation()
    found.no_padding()
    return found


def _encoder(path: str):
    """Encode words that come sorted: each run of equal words once, also across batches. The ids go on by block."""

    def encoded(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, pa.ListArray]]:
        tokenizer, sizes = _tokenizer(path), pc.binary_length(_pieces(path)).to_numpy()
        last, last_ids = None, np.zeros(0, np.int32)
        for batch in batches:
            if not len(batch):
                continue
            runs = pc.run_end_encode(batch.column("word"), run_end_type=pa.int32())
            words, ends = runs.values.to_pylist(), runs.run_ends.to_numpy()
            known = words[0] == last
            found = [last_ids] * known + _encoded(tokenizer, sizes, words[known:])
            last, last_ids = words[-1], found[-1]
            of_row = np.repeat(np.arange(len(found)), np.diff(ends, prepend=0))
            at = np.concatenate(([0], np.cumsum([len(x) for x in found]))).astype(np.int32)
            yield batch, pa.ListArray.from_arrays(pa.array(at), pa.array(np.concatenate(found))).take(pa.array(of_row))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch, ids in encoded(batches):
            held.append((batch, ids))
            rows += len(batch)
            if rows >= HELD:
                yield _by_block(held)
                held, rows = [], 0
        if held:
            yield _by_block(held)
        pa.default_memory_pool().release_unused()

    return run


def _by_block(held: list[tuple[pa.RecordBatch, pa.ListArray]]) -> pa.RecordBatch:
    files, rows, codes = (np.concatenate([b.column(c).to_numpy() for b, _ in held]) for c in ("file", "row", "code"))
    order = np.lexsort((codes, rows, files))
    files, rows, codes = files[order], rows[order], codes[order]
    ids = pa.concat_arrays([i for _, i in held]).take(pa.array(order))
    sizes = ids.value_lengths().to_numpy(zero_copy_only=False)
    flat, ends = ids.flatten().to_numpy(), np.concatenate(([0], np.cumsum(sizes)))
    cuts = np.flatnonzero((np.diff(files) != 0) | (np.diff(rows) != 0)) + 1
    pack, blobs = zstandard.ZstdCompressor(level=1), []
    starts = np.concatenate(([0], cuts))
    for a, b in zip(starts, [*cuts, len(codes)]):
        blobs.append(pack.compress(_planes(np.concatenate(([b - a], codes[a:b], sizes[a:b], flat[ends[a] : ends[b]])))))
    return pa.RecordBatch.from_arrays([pa.array(files[starts]), pa.array(rows[starts]), pa.array(blobs, pa.binary())], ["file", "row", "words"])


def _encoded(tokenizer, sizes: np.ndarray, words: list[str]) -> list[np.ndarray]:
    """The ids of every word. Words that may stand one after another in a text are encoded as one (a call costs more
    than a word); the bytes of the pieces tell where each ends."""
    chain = [i for i, w in enumerate(words) if w[0] == " " and not w[1:2].isspace() and not w[-1].isspace()]
    found = [np.zeros(0, np.int32)] * len(words)
    links = [chain[at : at + 256] for at in range(0, len(chain), 256)]
    for link, code in zip(links, tokenizer.encode_batch_fast(["".join([words[i] for i in x]) for x in links], add_special_tokens=False)):
        ids = np.array(code.ids, np.int32)
        ends = np.searchsorted(np.cumsum(sizes[ids]), np.cumsum([len(words[i].encode()) for i in link])) + 1
        for i, a, b in zip(link, np.concatenate(([0], ends[:-1])).tolist(), ends.tolist()):
            found[i] = ids[a:b]
    chained = set(chain)
    alone = [i for i in range(len(words)) if i not in chained]
    for i, code in zip(alone, tokenizer.encode_batch_fast([words[i] for i in alone], add_special_tokens=False)):
        found[i] = np.array(code.ids, np.int32)
    return found


@cache
def _pieces(path: str) -> pa.Array:
    """The bytes of every id. The file writes a byte as a character: itself where printable, else one from 256 on."""
    with open(path, encoding="utf-8") as file:
        found = json.load(file)
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    odd = [b for b in range(256) if b not in plain]
    byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(odd)}
    pieces = {i: bytes(byte_of[c] for c in piece) for piece, i in found["model"]["vocab"].items()}
    pieces |= {t["id"]: t["content"].encode() for t in found["added_tokens"]}
    return pa.array([pieces.get(i, b"") for i in range(max(pieces) + 1)], pa.large_binary())
