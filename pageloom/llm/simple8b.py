"""Operator 10: token ids in binary files, packed by Simple-8b.

A 64-bit word holds a selector in its low 4 bits and above it as many values
of one width as the selector names.  A value too wide for 60 bits is escaped:
selector 15, then the value as a raw word.  Words are packed block by block
(a word never reaches over a block's end), and a file lists the word at which
each block starts, so that any block, or all at once, decode with array
operations.  A file, all little-endian::

    8 bytes   magic "PLTOKS01"
    6 x u64   documents, ids, words, ids per block, blocks, bytes of names
    u64[]     id at which each document starts, and the end of the last
    u64[]     word at which each block starts
    u64[]     words
    bytes     names: the documents' identifiers as an Arrow stream

A file is named by the number of ids before its first (as the segments of a
log are), so a file can be read, and its documents placed, without any other.

Cases: a null text is the empty text, whose ids are the end id alone;
repeated rows are written once each; equal identifiers are ordered by text;
null identifiers come first; an empty table writes no file and reads back as
no rows.  Only the id and text columns are read.
"""

from __future__ import annotations

import os
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pageloom.llm.common import python_ready, running_sums, shuffle_partitions, written
from pageloom.llm.splits import TextCoder
from pageloom.session import checkpoint_dir, new_run_id

MAGIC = b"PLTOKS01"
#: Fixed values of the format: values per word for selectors 0 to 13.
COUNTS = (60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1)
WIDTHS = tuple(60 // c for c in COUNTS)
ESCAPE = 15
BLOCK = 4096
#: A file is closed when it holds this many ids (at its document's end).
FILE_IDS = 2_000_000


#: Bits of every 16-bit value.
_SHORT = np.maximum(np.frexp(np.arange(1 << 16, dtype=np.float64))[1], 1).astype(np.uint8)


def _bit_lengths(values: np.ndarray) -> np.ndarray:
    """Bits of each unsigned 64-bit value (1 for 0; above 2^53 it may be one too many)."""
    if values.max(initial=0) < len(_SHORT):
        return _SHORT[values]
    return np.maximum(np.frexp(values.astype(np.float64))[1], 1).astype(np.uint8)


def pack(values: np.ndarray, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray]:
    """Words of the values, and the word at which each block starts."""
    values = np.ascontiguousarray(values, dtype=np.uint64)
    n = len(values)
    if not n:
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    bits = _bit_lengths(values)
    # widest[p] = most bits among the c values from p; grows with c
    # values from p to its block's end, as far as a word can hold
    room = np.tile(np.minimum(np.arange(block, 0, -1), COUNTS[0]).astype(np.uint8), -(-n // block))[:n]
    tail = min(n, COUNTS[0])
    room[n - tail:] = np.minimum(room[n - tail:], np.arange(tail, 0, -1))
    selector = np.full(n, ESCAPE, np.uint8)
    step = np.ones(n, np.uint8)
    widest, have = bits.copy(), 1
    for sel in range(len(COUNTS) - 1, -1, -1):
        c, width = COUNTS[sel], WIDTHS[sel]
        while have < c:
            m = n - have
            if m <= 0:
                break
            widest = widest[:m]
            widest = np.maximum(widest, bits[have:])
            have += 1
        if have < c:
            break
        fits = (widest <= width) & (room[:len(widest)] >= c)
        if not fits.any():
            break  # where more values fit, fewer do
        np.putmask(selector[:len(widest)], fits, sel)
        np.putmask(step[:len(widest)], fits, c)
    steps, starts, p = step.tolist(), [], 0
    while p < n:
        starts.append(p)
        p += steps[p]
    at = np.array(starts, np.int64)
    sels = selector[at]
    size = 1 + (sels == ESCAPE)
    place = np.cumsum(size) - size
    words = np.zeros(int(size.sum()), np.uint64)
    words[place] = sels
    for sel in np.unique(sels).tolist():
        mine = sels == sel
        if sel == ESCAPE:
            words[place[mine] + 1] = values[at[mine]]
            continue
        packed = np.zeros(int(mine.sum()), np.uint64)
        for j in range(COUNTS[sel]):
            packed |= values[at[mine] + j] << np.uint64(4 + j * WIDTHS[sel])
        words[place[mine]] |= packed
    return words, place[np.flatnonzero(at % block == 0)].astype(np.uint64)


def unpack(words: np.ndarray) -> np.ndarray:
    """The values of a run of words that starts at a block's start."""
    words = np.asarray(words, dtype=np.uint64)
    sels = (words & np.uint64(15)).astype(np.uint8)
    raw = np.zeros(len(words), bool)
    for p in np.flatnonzero(sels == ESCAPE).tolist():  # the word after an escape is no selector
        if not raw[p]:
            raw[p + 1] = True
    head = np.flatnonzero(~raw)
    sels = sels[head]
    counts = np.ones(16, np.int64)
    counts[:len(COUNTS)] = COUNTS
    size = counts[sels]
    place = np.cumsum(size) - size
    out = np.empty(int(size.sum()), np.uint64)
    for sel in np.unique(sels).tolist():
        mine = sels == sel
        if sel == ESCAPE:
            out[place[mine]] = words[head[mine] + 1]
            continue
        body, mask = words[head[mine]], np.uint64((1 << WIDTHS[sel]) - 1)
        for j in range(COUNTS[sel]):
            out[place[mine] + j] = (body >> np.uint64(4 + j * WIDTHS[sel])) & mask
    return out


def file_bytes(docs: list[np.ndarray], names: pa.Array) -> bytes:
    """A file of the documents' ids and names."""
    lengths = np.array([len(d) for d in docs], np.int64)
    words, blocks = pack(np.concatenate(docs) if docs else np.empty(0, np.uint64))
    sink = pa.BufferOutputStream()
    column = pa.RecordBatch.from_arrays([names], ["name"])
    with pa.ipc.new_stream(sink, column.schema) as stream:
        stream.write_batch(column)
    named = sink.getvalue().to_pybytes()
    head = np.array([len(docs), lengths.sum(), len(words), BLOCK, len(blocks), len(named)], "<u8")
    starts = np.concatenate([[0], np.cumsum(lengths)]).astype("<u8")
    return b"".join([MAGIC, head.tobytes(), starts.tobytes(), blocks.astype("<u8").tobytes(),
                     words.astype("<u8").tobytes(), named])


def read_file(content: bytes) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """``(names, starts, ids)`` of a file: document k's ids are ``ids[starts[k]:starts[k + 1]]``."""
    if content[:8] != MAGIC:
        raise ValueError("not a token file")
    n_docs, n_ids, n_words, _, n_blocks, n_named = np.frombuffer(content, "<u8", 6, 8).tolist()
    starts = np.frombuffer(content, "<u8", n_docs + 1, 56)
    first = 56 + 8 * (n_docs + 1 + n_blocks)
    ids = unpack(np.frombuffer(content, "<u8", n_words, first))
    if len(ids) != n_ids:
        raise ValueError("a token file does not hold the ids it announces")
    named = pa.py_buffer(content).slice(first + 8 * n_words, n_named)
    return pa.ipc.open_stream(named).read_next_batch().column(0), starts, ids


def read_block(content: bytes, block: int) -> np.ndarray:
    """The ids of one block, decoded without the others."""
    n_docs, _, n_words, _, n_blocks, _ = np.frombuffer(content, "<u8", 6, 8).tolist()
    offsets = np.frombuffer(content, "<u8", n_blocks, 56 + 8 * (n_docs + 1)).tolist() + [n_words]
    first = 56 + 8 * (n_docs + 1 + n_blocks + offsets[block])
    return unpack(np.frombuffer(content, "<u8", offsets[block + 1] - offsets[block], first))


#: One coder per worker process and tokenizer.
_CODERS: dict[tuple, TextCoder | _WithAdded] = {}


class _WithAdded:
    """Codes of whole texts where the tokenizer's added tokens count: a text
    that holds one's string is left to the tokenizer, others to ``coder``."""

    def __init__(self, coder: TextCoder, tok):
        self.coder, self.tok = coder, tok
        self.added = [t.content for t in tok.get_added_tokens_decoder().values()]

    def encode(self, text: str | None) -> bytes:
        if text and any(a in text for a in self.added):
            return array("I", self.tok.encode(text, add_special_tokens=False).ids).tobytes()
        return self.coder.encode(text)


def _coder(key: tuple, tokenizer_json: str) -> TextCoder | _WithAdded:
    if key not in _CODERS:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        tok = Tokenizer.from_str(tokenizer_json)
        tok.encode_special_tokens = not key[2]  # if so, their strings in a text are ordinary text
        if "ByteLevel(add_prefix_space=False" in repr(tok.pre_tokenizer) and tok.normalizer is None:
            # a match is one piece to the model, spelled in the byte-level alphabet:
            # printable bytes stand for themselves, the others for 256 and up
            model, plain = tok.model, {*range(33, 127), *range(161, 173), *range(174, 256)}
            others = [b for b in range(256) if b not in plain]
            letters = {b: 256 + i for i, b in enumerate(others)}
            space, merged = chr(letters[32]), model.tokenize

            def code(match):
                if match.isascii() and match.isprintable():  # of these only the space is spelled otherwise
                    spelled = match.replace(" ", space)
                else:
                    spelled = match.encode().decode("latin-1").translate(letters)
                return array("I", [p.id for p in merged(spelled)]).tobytes()
        else:
            def code(match):
                return array("I", tok.encode(match, add_special_tokens=False).ids).tobytes()
        _CODERS.clear()
        coder = TextCoder(key[1], code)
        _CODERS[key] = _WithAdded(coder, tok) if key[2] else coder
    return _CODERS[key]


def write_files(docs: DataFrame, folder: str, tokenizer_path: str, pattern: str, end_id: int = 2,
                id_col: str = "doc_id", text_col: str = "text", added: bool = False) -> DataFrame:
    """Encode every whole text, append ``end_id`` and write the ids in
    ascending order of ``id_col`` to files under ``folder`` (a URI that the
    executors share).  Returns a written table with one row per file:
    ``file`` (its final name), ``base`` (the ids before it), ``ids``.  With
    ``added``, the strings of the tokenizer's added tokens get their ids, as
    the tokenizer by itself does; else they are ordinary text.

    The rows are range-partitioned by id; a task writes its range as files of
    about ``FILE_IDS`` ids.  A file is written under a name of the attempt
    and then renamed, and its content depends on the rows alone, so a task
    that runs again replaces it by the same.  When all lengths are known, a
    second small job renames each file to its base."""
    spark = python_ready(docs)
    with open(tokenizer_path, encoding="utf-8") as f:
        vocabulary = spark.sparkContext.broadcast(f.read())  # one vocabulary: its size does not depend on the data
    key, rows = (tokenizer_path, pattern, added), docs.select(id_col, text_col)
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        from pyarrow import fs as pafs
        from pyspark import TaskContext
        context = TaskContext.get()
        part, attempt = context.partitionId(), context.taskAttemptId()
        store, base = pafs.FileSystem.from_uri(folder)
        coder, seq, held, names, n_ids = _coder(key, vocabulary.value), 0, [], [], 0

        def close():
            name = f"_part-{part:06d}-{seq:06d}"
            store.create_dir(base, recursive=True)
            with store.open_output_stream(f"{base}/{name}.{attempt}") as out:
                out.write(file_bytes(held, pa.concat_arrays(names)))
            store.move(f"{base}/{name}.{attempt}", f"{base}/{name}")
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([n_ids], pa.int64())],
                ["part", "seq", "ids"])

        for batch in batches:
            for k, text in enumerate(batch.column(1).to_pylist()):
                held.append(np.frombuffer(coder.encode(text) + end, "<u4"))
                names.append(batch.column(0).slice(k, 1))
                n_ids += len(held[-1])
                if n_ids >= FILE_IDS:
                    yield close()
                    held, names, n_ids, seq = [], [], 0, seq + 1
        if held:
            yield close()

    def rename(batches):
        from pyarrow import fs as pafs
        store, base = pafs.FileSystem.from_uri(folder)
        for batch in batches:
            names = []
            for part, seq, before in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3)), strict=True):
                names.append(f"{before:020d}.pltok")
                if store.get_file_info(f"{base}/{names[-1]}").type == pafs.FileType.NotFound:  # else an attempt did it
                    store.move(f"{base}/_part-{part:06d}-{seq:06d}", f"{base}/{names[-1]}")
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), batch.column(3), batch.column(2)],
                                             ["file", "base", "ids"])

    order = [F.col(id_col), F.xxhash64(text_col)]
    parts = written(rows.repartitionByRange(shuffle_partitions(spark), *order).sortWithinPartitions(*order)
                    .mapInArrow(run, "part int, seq int, ids bigint"), "token-parts")
    based = running_sums(parts, [], ["part", "seq"], {"base": "ids"}, "token-bases")
    return written(based.mapInArrow(rename, "file string, base bigint, ids bigint"), "token-files")


def read_files(spark: SparkSession, folder: str, id_type: T.DataType, id_col: str = "doc_id") -> DataFrame:
    """Read the files of ``folder`` back: ``id_col, start, ids`` per document,
    ``start`` counting all ids before it in all files, ``ids`` as
    little-endian unsigned 32-bit integers (binary)."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.pltok").load(folder)
    named = files.select(F.element_at(F.split("path", "/"), -1).alias("name"), "content")
    python_ready(named)

    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                base = int(batch.column(0)[k].as_py().split(".")[0])
                names, starts, ids = read_file(batch.column(1)[k].as_py())
                ids, cuts = ids.astype("<u4"), starts.tolist()
                for i in range(0, len(names), 500):
                    to = range(i, min(i + 500, len(names)))
                    yield pa.RecordBatch.from_arrays(
                        [names.slice(i, 500), pa.array([base + cuts[j] for j in to], pa.int64()),
                         pa.array([ids[cuts[j]:cuts[j + 1]].tobytes() for j in to], pa.binary())],
                        [id_col, "start", "ids"])

    return named.mapInArrow(run, T.StructType([T.StructField(id_col, id_type), T.StructField("start", T.LongType()),
                                               T.StructField("ids", T.BinaryType())]))


def token_files(docs: DataFrame, tokenizer_path: str, pattern: str, end_id: int = 2,
                id_col: str = "doc_id", text_col: str = "text", added: bool = False) -> DataFrame:
    """Write ``docs`` to a new folder beside the session's checkpoints and
    read the files back (:func:`write_files`, :func:`read_files`)."""
    base = checkpoint_dir(docs.sparkSession).rstrip("/")
    folder = f"{base if '://' in base or base.startswith('file:') else 'file://' + os.path.abspath(base)}/tokens-{new_run_id()}"
    files = write_files(docs, folder, tokenizer_path, pattern, end_id, id_col, text_col, added)
    spark, id_type = docs.sparkSession, docs.select(id_col).schema[0].dataType
    if not files.take(1):
        return spark.createDataFrame([], T.StructType([
            T.StructField(id_col, id_type), T.StructField("start", T.LongType()), T.StructField("ids", T.BinaryType())]))
    return read_files(spark, folder, id_type, id_col)


def digests(read: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``id_col, start, n_tokens, ids_crc32`` of :func:`read_files`' rows."""
    return read.select(id_col, "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                       F.crc32("ids").alias("ids_crc32"))


def default_tokenizer() -> tuple[str, str]:
    """Tokenizer file and split pattern of the public 50k vocabulary."""
    import public_tokenizers as P
    return P.path("byte_bpe_50k.json"), P.PATTERN
