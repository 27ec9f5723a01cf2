"""Token ids as Arrow stream files of equal-length sequences.

Documents are put in doc_id order (nulls first, equal ids by text) and range-partitioned;
each partition encodes its documents, ends each with `end_id`, lays the ids end to end and
cuts them into sequences of `length`. They are written as one Arrow stream file a shard,
whose record batches hold fixed-size lists: `input_ids` (the narrowest unsigned type the
vocabulary allows) and `mask` (true where a token is, false in the padding that ends the
shard). Batches but the last have equal size, and a memory-mapped file gives any sequence
as a view without copying. Beside it lies a stream file with the start and the length of
each document inside the shard.

A task writes under a name of its own and reports it in the manifest; only files of the
manifest count, so a task that runs twice does no harm. Null texts are empty texts and have
one id, the end. Rows that repeat are written again. Empty partitions write nothing; an
empty table gives an empty manifest. Only doc_id and text are read. Folders are opened with
pyarrow's file systems, so any shared storage that it knows will do.

Encoding: where a tokenizer's normaliser and pre-tokenizer never look across ASCII white
space, a text's ids are those of its words in turn. Each distinct word of a run of texts is
then encoded once by the library and its ids are put in place with Arrow. `by_words` checks
the tokenizer's declaration for that; other tokenizers encode whole texts. Case is folded
first where the declaration folds it anyway, and a mark is parted from the letter before it
where the declared pattern does so, which makes fewer distinct words and the same ids. Words
of small letters go past the declared steps that leave them as they are, straight to the model.

The tasks that a Python process runs in turn share one encoder. It remembers words and their
ids up to a bound in bytes, beyond which the half used last is kept.
"""

from __future__ import annotations

import functools
import json
import os
import re
import unicodedata
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from clickcohort.llm.common import shared_folder, stored
from clickcohort.llm.token_counts import by_bytes

LENGTH, BATCH = 2048, 64
_RUN_BYTES = 4 << 20
#: Bytes of remembered words and ids, at 32 more for each word.
_KNOWN_BYTES, _GROUP = 20 << 20, 128
#: Fixed value: the declared pattern by which a letter and a mark after it are always parted.
_LETTERS_OR_MARKS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_MARKS = r".,;:!?*%&$#"
#: Small Latin, Greek and Cyrillic letters: folding and composing leave them as they are.
_SMALL = "".join(c for c in map(chr, range(0x61, 0x460)) if unicodedata.category(c) == "Ll")
_MANIFEST = "shard int, name string, n_docs bigint, n_ids bigint"


class Encoder:
    """Ids of texts, end id included, as one array and the number of ids of each text."""

    def __init__(self, path: str, end_id: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.end = end_id
        size = max(self.tokenizer.get_vocab_size(), end_id + 1)
        self.kind = np.dtype(np.uint16 if size <= 1 << 16 else np.uint32)
        self.words = pa.array([], pa.large_string())
        self.coded = pa.array([], pa.large_binary())
        self.used, self.runs = np.empty(0, dtype=np.int64), 0
        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        self.by_words = by_words(told)
        if self.by_words:
            self.added = [a["content"] for a in told["added_tokens"]]
            self.folds = any(x["type"] == "Lowercase" for x in _steps(told["normalizer"],
                                                                     "normalizers"))
            first, *others = _steps(told["pre_tokenizer"], "pretokenizers")
            pattern = first["pattern"]["Regex"]
            self.parts = pattern == _LETTERS_OR_MARKS and not any(
                re.search(r"\w[^\w\s]", a) and re.search(f"[a-zA-Z][{_MARKS}]", a)
                for a in self.added)
            suffix = told["model"].get("end_of_word_suffix")
            self.closes = np.zeros(size, dtype=bool)
            for token, number in self.tokenizer.get_vocab().items():
                self.closes[number] = bool(suffix) and token.endswith(suffix)
            # A run of letters is one piece, whose last token alone closes a word.
            self.groups = self.parts and self.closes.any() and not any(
                a.isalpha() for a in self.added)
            if self.groups:
                self.bare = Tokenizer(self.tokenizer.model)
                self.bare.pre_tokenizer = pre_tokenizers.Sequence(
                    [pre_tokenizers.WhitespaceSplit()] + [pre_tokenizers.ByteLevel(
                        add_prefix_space=False, use_regex=False) for _ in others])

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if self.by_words:
            return self._words(texts)
        ids = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        counts = np.array([len(x) + 1 for x in ids], dtype=np.int64)
        flat = [i for x in ids for i in (*x, self.end)]
        return np.array(flat, dtype=self.kind), counts

    def _simpler(self, texts: pa.Array) -> pa.Array:
        """Texts of the same ids with fewer distinct words."""
        if self.folds:
            folded = pc.ascii_lower(texts)
            for token in self.added:  # folding must not make an added token
                folded = pc.if_else(pc.match_substring(texts, token, ignore_case=True), texts,
                                    folded)
            texts = folded
        if self.parts:
            # All letters but U+0130, the only one that folds to a letter and a mark.
            texts = pc.replace_substring_regex(
                texts, rf"([^\P{{L}}\x{{130}}])([{_MARKS}])", r"\1 \2")
        return texts

    def _words(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        lists = pc.ascii_split_whitespace(self._simpler(pa.array(texts, pa.large_string())))
        # Known words come first in the dictionary, in their order.
        found = pa.chunked_array([self.words, lists.flatten()]).combine_chunks().dictionary_encode()
        index = found.indices.to_numpy(zero_copy_only=False)[len(self.words):]
        words = found.dictionary
        new = words.take(pa.array(np.arange(len(self.words), len(words))))
        coded = pa.concat_arrays([self.coded, self._new(new)])
        # The end of a text is laid like a word, the one after the last.
        last = np.cumsum(pc.list_value_length(lists).to_numpy() + 1) - 1
        laid = np.empty(len(index) + len(texts), dtype=np.int32)
        held = np.ones(len(laid), dtype=bool)
        held[last] = False
        laid[held], laid[last] = index, len(words)
        end = pa.array([np.array([self.end], dtype=self.kind).tobytes()], pa.large_binary())
        out = pa.concat_arrays([coded, end]).take(pa.array(laid))
        bounds, data = _parts(out)
        self._remember(words, coded, index)
        counts = np.diff(bounds[last + 1], prepend=0) // self.kind.itemsize
        return np.frombuffer(data, dtype=self.kind, count=bounds[-1] // self.kind.itemsize), counts

    def _remember(self, words: pa.Array, coded: pa.Array, index: np.ndarray) -> None:
        self.runs += 1
        used = np.zeros(len(words), dtype=np.int64)
        used[:len(self.used)] = self.used
        used[index] = self.runs
        held = np.diff(_parts(words)[0]) + np.diff(_parts(coded)[0]) + 32
        if held.sum() > _KNOWN_BYTES:
            latest = np.argsort(-used, kind="stable")
            keep = np.sort(latest[np.cumsum(held[latest]) <= _KNOWN_BYTES // 2])
            words, coded, used = words.take(pa.array(keep)), coded.take(pa.array(keep)), used[keep]
        self.words, self.coded, self.used = words, coded, used

    def _new(self, words: pa.Array) -> pa.Array:
        """Ids of words, as bytes."""
        texts = words.to_numpy(zero_copy_only=False).tolist()
        if not self.groups:
            return pa.array(self._single(texts), pa.large_binary())
        bare = pc.match_substring_regex(words, f"^[{_SMALL}]+$").to_numpy(zero_copy_only=False)
        letters = ~bare & np.fromiter(map(str.isalpha, texts), dtype=bool, count=len(texts))
        rest = [np.flatnonzero(~bare & ~letters)]
        places, found = [], []
        for tokenizer, chosen in ((self.bare, bare), (self.tokenizer, letters)):
            at = np.flatnonzero(chosen)
            groups = [at[k:k + _GROUP] for k in range(0, len(at), _GROUP)]
            joined = [" ".join([texts[i] for i in g.tolist()]) for g in groups]
            for group, ids in zip(groups, self._encoded(tokenizer, joined)):
                raw = np.array(ids, dtype=self.kind)
                ends = np.flatnonzero(self.closes[raw]) + 1
                if len(ends) != len(group):
                    rest.append(group)
                    continue
                places.append(group)
                found.append(_binary(raw[:ends[-1]], ends))
        places.append(np.concatenate(rest))
        found.append(pa.array(self._single([texts[i] for i in places[-1].tolist()]),
                              pa.large_binary()))
        return pa.concat_arrays(found).take(pa.array(np.argsort(np.concatenate(places))))

    def _single(self, texts: list[str]) -> list[bytes]:
        return [np.array(ids, dtype=self.kind).tobytes()
                for ids in self._encoded(self.tokenizer, texts)]

    def _encoded(self, tokenizer, texts: list[str]) -> Iterator[list[int]]:
        for at in range(0, len(texts), 64):
            for found in tokenizer.encode_batch_fast(texts[at:at + 64], add_special_tokens=False):
                yield found.ids


@functools.lru_cache(maxsize=1)
def _loaded(path: str, end_id: int, stamp: tuple[int, int]) -> Encoder:
    return Encoder(path, end_id)


def encoder_of(path: str, end_id: int) -> Encoder:
    """The process's encoder, with the words that it knows; a changed file is read again."""
    told = os.stat(path)
    return _loaded(path, end_id, (told.st_mtime_ns, told.st_size))


def _binary(ids: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Runs of ids as bytes, given where each run ends."""
    bounds = np.concatenate([[0], ends]).astype(np.int64) * ids.itemsize
    return pa.Array.from_buffers(pa.large_binary(), len(ends),
                                 [None, pa.py_buffer(bounds), pa.py_buffer(ids.tobytes())])


def _parts(values: pa.Array) -> tuple[np.ndarray, pa.Buffer]:
    """Bounds of large strings or binaries in their data, and the data."""
    _, bounds, data = values.buffers()
    at = values.offset
    return np.frombuffer(bounds, dtype=np.int64)[at:at + len(values) + 1], data


def _steps(declared: dict | None, key: str) -> list[dict]:
    return declared.get(key, [declared]) if declared else []


def by_words(told: dict) -> bool:
    """Whether a tokenizer file declares only steps that keep apart what white space parts."""
    normal = _steps(told["normalizer"], "normalizers")
    split = _steps(told["pre_tokenizer"], "pretokenizers")
    if not all(x["type"] in ("NFC", "Lowercase") or x == {
            "type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "} for x in normal):
        return False
    first = split[0] if split else {}
    pattern = first.get("pattern", {}).get("Regex", "")
    # Matches are kept, all else is dropped, and no match holds white space.
    parts_at_space = (first.get("type") == "Split" and first.get("behavior") == "Removed"
                      and first.get("invert") is True and not _meets_space(pattern))
    rest = all(x["type"] == "ByteLevel" and not x["add_prefix_space"] and not x["use_regex"]
               for x in split[1:])
    added = all(not any(c in a["content"] for c in " \t\n\x0b\x0c\r") and not a["lstrip"]
                and not a["rstrip"] and not a["single_word"] and not a["normalized"]
                for a in told["added_tokens"])
    return parts_at_space and rest and added and told["post_processor"] is None


def _meets_space(pattern: str) -> bool:
    """Whether a match could hold white space or depend on what stands beside it."""
    plain = re.sub(r"\[\^\\s[^\]]*\]", "", pattern)  # classes that leave white space out
    return any(x in plain for x in (" ", "\t", "\n", ".", "\\s", "[^", "\\P", "\\W", "\\D", "(?",
                                    "\\b", "\\B", "^", "$"))


def open_folder(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder named by a URI (Spark writes file:/x for a local one)."""
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[len("file:"):].lstrip("/")
    return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)


def sequence_schema(kind, length: int) -> pa.Schema:
    item = pa.field("item", pa.from_numpy_dtype(kind), nullable=False)
    flag = pa.field("item", pa.bool_(), nullable=False)
    return pa.schema([pa.field("input_ids", pa.list_(item, length), nullable=False),
                      pa.field("mask", pa.list_(flag, length), nullable=False)])


_DOCS = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])


class ShardWriter:
    """Lays ids end to end and writes full batches as they come."""

    def __init__(self, folder: str, name: str, kind, length: int, batch: int):
        self.files, path = open_folder(folder)
        self.files.create_dir(path, recursive=True)
        self.schema, self.kind, self.length, self.batch = sequence_schema(kind, length), kind, \
            length, batch
        self.streams = [self.files.open_output_stream(f"{path}/{name}.{part}")
                        for part in ("arrow", "docs.arrow")]
        self.ids = pa.ipc.new_stream(self.streams[0], self.schema)
        self.docs = pa.ipc.new_stream(self.streams[1], _DOCS)
        self.waiting: list[np.ndarray] = []
        self.n_waiting = self.n_ids = self.n_docs = 0

    def add(self, doc_ids: pa.Array, ids: np.ndarray, counts: np.ndarray) -> None:
        start = self.n_ids + np.cumsum(counts) - counts
        self.docs.write_batch(pa.record_batch([doc_ids, pa.array(start), pa.array(counts)],
                                              schema=_DOCS))
        self.waiting.append(ids)
        self.n_waiting += len(ids)
        self.n_ids += len(ids)
        self.n_docs += len(counts)
        full = self.n_waiting // (self.length * self.batch) * self.length * self.batch
        if full:
            laid = np.concatenate(self.waiting)
            for at in range(0, full, self.length * self.batch):
                self._write(laid[at:at + self.length * self.batch], self.length * self.batch)
            self.waiting, self.n_waiting = [laid[full:]], len(laid) - full

    def _write(self, ids: np.ndarray, real: int) -> None:
        mask = np.arange(len(ids)) < real
        columns = [pa.FixedSizeListArray.from_arrays(pa.array(x), type=field.type)
                   for x, field in zip((ids, mask), self.schema)]
        self.ids.write_batch(pa.record_batch(columns, schema=self.schema))

    def close(self) -> None:
        if self.n_waiting:
            laid = np.concatenate(self.waiting)
            room = -(-len(laid) // self.length) * self.length
            self._write(np.concatenate([laid, np.zeros(room - len(laid), self.kind)]), len(laid))
        for writer in (self.ids, self.docs, *self.streams):
            writer.close()


class ShardReader:
    """Random access to the sequences and masks of a shard; local files are memory-mapped."""

    def __init__(self, folder: str, name: str):
        files, path = open_folder(folder)

        def opened(part: str):
            at = f"{path}/{name}.{part}"
            if isinstance(files, fs.LocalFileSystem):
                return pa.memory_map(at)
            return pa.BufferReader(files.open_input_file(at).readall())
        self.batches = list(pa.ipc.open_stream(opened("arrow")))
        self.docs = pa.ipc.open_stream(opened("docs.arrow")).read_all()
        self.per_batch = len(self.batches[0]) if self.batches else 1

    def __len__(self) -> int:
        return sum(len(b) for b in self.batches)

    def sequence(self, index: int) -> tuple[np.ndarray, pa.Array]:
        """Ids (a view of the file) and the mask of one sequence."""
        batch, row = divmod(index, self.per_batch)
        ids, mask = (self.batches[batch].column(k)[row].values for k in (0, 1))
        return ids.to_numpy(zero_copy_only=True), mask

    def ids(self) -> np.ndarray:
        """All ids under the mask, in order."""
        if not self.batches:
            return np.empty(0, dtype=np.uint16)
        flat = [b.column(0).flatten().to_numpy(zero_copy_only=True) for b in self.batches]
        last = self.batches[-1].column(1).flatten().to_numpy(zero_copy_only=False)
        flat[-1] = flat[-1][last]
        return np.concatenate(flat)


#: Characters of a text that take part in the range key, which is sampled to the driver.
_PREFIX = 64


def write_tokens(docs: DataFrame, path: str, folder: str, end_id: int = 2, length: int = LENGTH,
                 batch: int = BATCH) -> DataFrame:
    """Encode and write all documents; the manifest: shard, name, n_docs and n_ids of each."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    # The first characters sort as the texts do, so texts of one id may go to several shards.
    placed = rows.repartitionByRange(
        F.asc_nulls_first("doc_id"), F.substring("text", 1, _PREFIX)).sortWithinPartitions(
        F.asc_nulls_first("doc_id"), "text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId()
        encoder, out = None, None
        name = f"shard-{shard:06d}-{uuid.uuid4().hex}"
        for found in batches:
            if not len(found):
                continue
            if out is None:
                encoder = encoder_of(path, end_id)
                out = ShardWriter(folder, name, encoder.kind, length, batch)
            at = 0
            for run in by_bytes(found.column("text").to_pylist(), _RUN_BYTES):
                out.add(found.column("doc_id").slice(at, len(run)), *encoder(run))
                at += len(run)
        if out is not None:
            out.close()
            yield pa.record_batch([pa.array([shard], pa.int32()), pa.array([name]),
                                   pa.array([out.n_docs]), pa.array([out.n_ids])],
                                  names=["shard", "name", "n_docs", "n_ids"])
    # Written out at once: were it computed again, the files would be written again.
    return stored(placed.mapInArrow(write, _MANIFEST), "token-manifest")


def read_documents(spark: SparkSession, manifest: DataFrame, folder: str) -> DataFrame:
    """doc_id, start (over all shards), n_tokens and ids_crc32, read back from the files."""
    order = Window.orderBy("shard")  # one row a shard, not a document
    based = manifest.withColumn("base", F.sum("n_ids").over(order) - F.col("n_ids"))
    spread = based.repartition(max(1, manifest.count()), "shard")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found in batches:
            for name, base in zip(found.column("name").to_pylist(),
                                  found.column("base").to_pylist()):
                shard = ShardReader(folder, name)
                ids = shard.ids()
                for docs in shard.docs.to_batches():
                    start, count = (docs.column(k).to_numpy() for k in ("start", "n_tokens"))
                    sums = [zlib.crc32(ids[a:a + n].astype("<u4").tobytes())
                            for a, n in zip(start, count)]
                    yield pa.record_batch(
                        [docs.column("doc_id"), pa.array(start + base), docs.column("n_tokens"),
                         pa.array(sums, pa.int64())],
                        names=["doc_id", "start", "n_tokens", "ids_crc32"])
    return spread.mapInArrow(
        read, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def token_folder(spark: SparkSession) -> str:
    return shared_folder(spark, "token-files")
