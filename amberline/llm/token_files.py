"""Token ids in Arrow files of fixed-size lists.

The token stream of a file is cut into sequences of equal length; each is one value of a
``fixed_size_list`` column, with a mask of the same length that is false only in the padding of
the last one. Both columns can be memory-mapped: sequence i lies at a fixed offset of its record
batch, so any of them is read without decoding others. A second file lists the documents.
"""

from __future__ import annotations

import json
import uuid
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from amberline.llm.common import open_store, saved, slices, texts
from amberline.session import scratch_path

LENGTH = 2048
SEQUENCES = 64
CACHE = 600_000
UNKNOWN = 2000
SLICE_BYTES = 4 << 20
# Rules of a tokenizer that gives marks behind a letter ids of their own, and those of a text in lower case.
# Neither rule joins such a letter with a mark, and Unicode never composes the two.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
PRE_TOKENIZER = {
    "type": "Sequence",
    "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": PATTERN}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}
TAIL = r"([A-Za-zÀ-ÖØ-öø-ÿ])([.,;:!?]+)$"


class WordEncoder:
    """Ids of whole texts by the ids of their words.

    No token crosses white space, so a text's ids are those of its words, cut at ASCII's, one after the other. Each
    word goes through the tokenizer once, many in one call, then to a bounded cache.
    With ``added``, texts that hold an added token, as ``<|endoftext|>``, go through the tokenizer
    whole, which gives it the token's id as the library does by default; else it is read as text.
    """

    def __init__(self, path: str, added: bool = False):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not added
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        tokens = self.tokenizer.get_added_tokens_decoder().values() if added else ()
        # A token that is looked for in normalized text may stand in any text.
        self.added = [""] if any(t.normalized for t in tokens) else [t.content for t in tokens]
        self.kind = np.uint16 if self.tokenizer.get_vocab_size() <= 1 << 16 else np.uint32
        with open(path, encoding="utf-8") as file:
            rules = json.load(file)
        self.cuts_tails = rules["normalizer"] == NORMALIZER and rules["pre_tokenizer"] == PRE_TOKENIZER
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _ids(self, ids: list[int]) -> bytes:
        return np.array(ids, self.kind).tobytes()

    def learn(self, words: list[str]) -> None:
        """Put the ids of words into the cache."""
        size = np.dtype(self.kind).itemsize
        for low in range(0, len(words), UNKNOWN):
            part = words[low : low + UNKNOWN]
            found = self.tokenizer.encode(part, is_pretokenized=True, add_special_tokens=False)
            ids = self._ids(found.ids)
            ends = np.cumsum(np.bincount(np.array(found.word_ids, np.int64), minlength=len(part))) * size
            start = 0
            for word, end in zip(part, ends.tolist(), strict=True):
                self.known[word] = ids[start:end]
                start = end

    def encode(self, batch: list[str]) -> list[bytes]:
        """The ids of each text, as the bytes of little-endian numbers of ``kind``."""
        whole = [any(token in text for token in self.added) for text in batch]
        if any(whole):
            rest = iter(self.encode_words([text for text, all_of_it in zip(batch, whole, strict=True) if not all_of_it]))
            return [self._ids(self.tokenizer.encode(text, add_special_tokens=False).ids) if all_of_it else next(rest) for text, all_of_it in zip(batch, whole, strict=True)]
        return self.encode_words(batch)

    def ids_of(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of different words one after the other, and how many each has.

        Where the tokenizer is known to cut there anyway, words are taken without the marks behind them, and ASCII ones
        in lower case, so that fewer are different and unknown.
        """
        if not self.cuts_tails:
            return self.cached(words.to_pylist())
        cut = pc.ascii_split_whitespace(pc.replace_substring_regex(words, TAIL, r"\1 \2"))
        parts = cut.flatten()
        lower, plain = pc.ascii_lower(parts), pc.string_is_ascii(parts)
        for token in self.added:  # which no word becomes
            plain = pc.and_(plain, pc.invert(pc.match_substring(lower, token)))
        coded = pc.if_else(plain, lower, parts).dictionary_encode()
        ids, ends = gathered(*self.cached(coded.dictionary.to_pylist()), coded.indices.to_numpy())
        return ids, np.diff(ends[cut.offsets.to_numpy()])

    def cached(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """``ids_of`` of words as they are, through the cache."""
        if len(self.known) > CACHE:
            self.older, self.known = self.known, {}
        known, older = self.known, self.older
        fresh = []
        for word in words:
            if word not in known:
                if word in older:
                    known[word] = older[word]
                else:
                    fresh.append(word)
        known[""] = b""
        self.learn([word for word in fresh if word])
        own = [known[word] for word in words]
        return np.frombuffer(b"".join(own), self.kind), np.array([len(ids) for ids in own], np.int64) // np.dtype(self.kind).itemsize

    def encode_words(self, batch: list[str]) -> list[bytes]:
        """The ids of texts without added tokens."""
        split = pc.ascii_split_whitespace(pa.array(batch, pa.large_string()))
        coded = split.flatten().dictionary_encode()
        own, sizes = self.ids_of(coded.dictionary)
        ids, ends = gathered(own, sizes, coded.indices.to_numpy())
        bounds = ends[split.offsets.to_numpy()].tolist()
        return [ids[low:high].tobytes() for low, high in zip(bounds[:-1], bounds[1:], strict=True)]


def gathered(ids: np.ndarray, sizes: np.ndarray, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of items that lie one after the other in ``ids``, those of ``index`` in its order, and the bounds between them."""
    starts, n = (np.cumsum(sizes) - sizes)[index], sizes[index]
    ends = np.concatenate([[0], np.cumsum(n)])
    return ids[np.arange(ends[-1]) + np.repeat(starts - ends[:-1], n)], ends


@lru_cache(1)
def encoder_of(path: str, added: bool) -> WordEncoder:
    """A worker's encoder: its cache, bounded as it is, serves all tasks that the worker runs."""
    return WordEncoder(path, added)


class SequenceWriter:
    """Writes a stream of token ids as batches of equal sequences."""

    def __init__(self, sink, kind, length: int):
        self.length, self.kind = length, np.dtype(kind)
        fields = [("ids", pa.list_(pa.from_numpy_dtype(kind), length)), ("mask", pa.list_(pa.bool_(), length))]
        self.schema = pa.schema(fields, metadata={"sequences": str(SEQUENCES)})  # in each batch but the last
        self.writer = pa.ipc.new_file(sink, self.schema)
        self.parts, self.waiting = [], 0

    def add(self, ids: bytes) -> None:
        self.parts.append(ids)
        self.waiting += len(ids) // self.kind.itemsize
        if self.waiting >= self.length * SEQUENCES:
            ids, size = np.frombuffer(b"".join(self.parts), self.kind), self.length * SEQUENCES
            for low in range(0, len(ids) - size + 1, size):
                self._put(ids[low : low + size])
            left = ids[len(ids) - len(ids) % size :]
            self.parts, self.waiting = [left.tobytes()], len(left)

    def _put(self, ids: np.ndarray) -> None:
        full = -(-len(ids) // self.length) * self.length
        mask = np.arange(full) < len(ids)
        ids = np.concatenate([ids, np.zeros(full - len(ids), self.kind)])
        columns = [pa.FixedSizeListArray.from_arrays(pa.array(x), self.length) for x in (ids, mask)]
        self.writer.write_batch(pa.RecordBatch.from_arrays(columns, schema=self.schema), None)

    def close(self) -> None:
        if self.waiting:
            self._put(np.frombuffer(b"".join(self.parts), self.kind))
        self.writer.close()


class SequenceReader:
    """Random access to the sequences of a file; memory-mapped where the store is local."""

    def __init__(self, path: str):
        store, name = open_store(path)
        self.source = pa.memory_map(name) if store.type_name == "local" else store.open_input_file(name)
        self.file = pa.ipc.open_file(self.source)
        self.length = self.file.schema.field("ids").type.list_size
        self.size = self.length * int(self.file.schema.metadata[b"sequences"])  # ids in each batch but the last
        self.at, self.flat = -1, np.empty(0)

    def sequence(self, i: int) -> tuple[np.ndarray, pa.Array]:
        """The ids (a view of the file) and the mask of sequence i."""
        k, low = divmod(i * self.length, self.size)
        ids = self._batch(k)
        mask = self.file.get_batch(self.at).column("mask").flatten().slice(low, self.length)
        return ids[low : low + self.length], mask

    def _batch(self, k: int) -> np.ndarray:
        if k != self.at:
            self.at, self.flat = k, self.file.get_batch(k).column("ids").flatten().to_numpy(zero_copy_only=True)
        return self.flat

    def tokens(self, start: int, n: int):
        """Views of the ids ``start`` to ``start + n``, one for each record batch that they lie in."""
        while n:
            k, low = divmod(start, self.size)
            ids = self._batch(k)
            found = ids[low : low + n]
            yield found
            start, n = start + len(found), n - len(found)


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 2, length: int = LENGTH) -> DataFrame:
    """Encode the texts of ``docs`` (``doc_id, text``), each followed by ``end_id``, into files in ascending doc_id order.

    Returns the files: ``part, path, docs_path, n_docs, n_tokens, start`` (tokens of all files
    before). Null ids come first, equal ids by their text; a null text is empty and has only the
    end id. Ids are those of the library's ``encode(text, add_special_tokens=False)``, also for added
    tokens in a text. An empty table gives no file. A task that runs again writes files of other names, of
    which only those that its last run lists count.
    """

    def run(batches):
        encoder, part, name = encoder_of(tokenizer, True), TaskContext.get().partitionId(), uuid.uuid4().hex
        store, base = open_store(folder)
        store.create_dir(base, recursive=True)
        ids_path, docs_path = f"{folder}/{part:06}-{name}.tokens.arrow", f"{folder}/{part:06}-{name}.docs.arrow"
        shape = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])
        end, total, n_docs, writers = np.array([end_id], encoder.kind).tobytes(), 0, 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            if not writers:
                sinks = [store.open_output_stream(open_store(p)[1]) for p in (ids_path, docs_path)]
                writers = SequenceWriter(sinks[0], encoder.kind, length), pa.ipc.new_file(sinks[1], shape)
            whole = texts(batch.column(1))
            for low, high in slices([len(text) for text in whole], SLICE_BYTES):
                rows = batch.slice(low, high - low)
                found = [ids + end for ids in encoder.encode(whole[low:high])]
                counts = np.array([len(ids) // np.dtype(encoder.kind).itemsize for ids in found], np.int64)
                for ids in found:
                    writers[0].add(ids)
                starts = total + np.cumsum(counts) - counts
                writers[1].write_batch(pa.RecordBatch.from_arrays([rows.column(0), pa.array(starts), pa.array(counts)], schema=shape))
                total += int(counts.sum())
                n_docs += rows.num_rows
        if writers:
            for x in (*writers, *sinks):
                x.close()
            yield pa.RecordBatch.from_pydict({"part": [part], "path": [ids_path], "docs_path": [docs_path], "n_docs": [n_docs], "n_tokens": [total]})

    rows = docs.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    files = saved(rows.mapInArrow(run, "part long, path string, docs_path string, n_docs long, n_tokens long"), "token-files")
    listed = sorted(files.collect(), key=lambda f: f.part)  # a row a file
    starts = np.cumsum([0, *(f.n_tokens for f in listed)]).tolist()
    rows = [(*f, start) for f, start in zip(listed, starts, strict=False)]
    return docs.sparkSession.createDataFrame(rows, "part long, path string, docs_path string, n_docs long, n_tokens long, start long")


def read_documents(files: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, read back from the files' sequences; no files give no rows."""

    def run(batches):
        shape = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])
        for batch in batches:
            for path, docs_path, base in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                reader = SequenceReader(path)
                store, name = open_store(docs_path)
                with store.open_input_file(name) as source:
                    listed = pa.ipc.open_file(source)
                    for i in range(listed.num_record_batches):
                        rows, sums = listed.get_batch(i), []
                        for start, n in zip(rows.column(1).to_pylist(), rows.column(2).to_pylist(), strict=True):
                            crc = 0
                            for ids in reader.tokens(start, n):
                                crc = zlib.crc32(ids.astype("<u4").tobytes(), crc)
                            sums.append(crc)
                        starts = pa.array(np.asarray(rows.column(1)) + base)
                        yield pa.RecordBatch.from_arrays([rows.column(0), starts, rows.column(2), pa.array(sums, pa.int64())], schema=shape)

    # With a number given, adaptive execution does not join the few bytes of many files into one task.
    parts = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = files.select("path", "docs_path", "start").repartition(parts, F.xxhash64("path"))
    return spread.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_round_trip(spark: SparkSession, docs: DataFrame, tokenizer: str, end_id: int = 2) -> DataFrame:
    """Write ``docs`` to token files in the shared folder and read their documents' figures back."""
    return read_documents(write_tokens(docs, scratch_path(spark, "tokens"), tokenizer, end_id))
