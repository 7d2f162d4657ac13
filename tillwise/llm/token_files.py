"""Token ids of documents in compressed binary files, each document readable by itself.

Ids are serialised little-endian, two bytes each if the vocabulary allows it, else four. A
zstandard dictionary is trained on the serialised arrays of a sample and shared by all
files; with it every document is compressed separately, so a short document costs few
bytes and can be read without its neighbours.

A file, all integers little-endian:

    magic (8 bytes) | XXH64 of the dictionary (8) | bytes of an id (1)
    frames, one for each document
    index: zstandard frame of  ends of frames (u64 each), ids a document has (u32 each),
           sizes of document names (i32 each, -1 for null), the names (UTF-8)
    documents (u64) | bytes of the index (u64) | magic (8)

Files follow the order of document ids. Each lies in one range of ids, and the manifest (a
Parquet table beside them: file, documents, ids, first id's place) has one row for each file.
A reader goes from the manifest to the index at the end of a file and from there to a frame; it
refuses a file whose dictionary hash is not that of the dictionary it holds.

Texts are encoded and compressed where they are read, so only compressed frames are
shuffled to their place in the order. A file is closed at FILE_BYTES, and a writer holds the
index of its open file only. A task writes under names of its own and returns
them; a name counts once it is in the manifest, so a task that is repeated after a lost
executor leaves at most a file nobody names. Files are written and read by the
address of the shared folder (spark.checkpoint.dir: a file, hdfs, s3 or gs address that
pyarrow opens). The driver handles one row a file to sum up where files begin.

Defined cases: a null text is empty, an empty text has the end id alone; documents of
equal ids follow each other in the order in which they are read; null ids come first; the
sample leaves out documents beyond SAMPLE_IDS ids and is SAMPLE documents (expected), and
where nothing can be trained on it the dictionary is made of the sample as it is (empty, if
need be); an empty table gives no file and an empty result.
"""

from __future__ import annotations

import os
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pandas as pd
import pyarrow.fs
import public_tokenizers
import tokenizers
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwise.functions.sizing import spread
from tillwise.llm import words
from tillwise.sinks.scratch import fresh_path, materialize

MAGIC = b"TLWIDS01"
END_ID = 2
LEVEL = 6
#: Documents of the sample (expected), and ids of the longest document in it.
SAMPLE = 4000
SAMPLE_IDS = 4096
DICTIONARY_BYTES = 64 << 10
#: Bytes at which a file is closed, and for which a writing task is planned.
FILE_BYTES = 128 << 20
#: A smaller table is cut further to occupy all cores, down to this.
LEAST_BYTES = 1 << 20
#: Bytes of frames that are read at once.
READ_BYTES = 4 << 20
#: Documents that are put together for Spark.
TEXTS = 64
#: Encoded words that a worker remembers (about 150 bytes each) before it begins anew.
KNOWN_WORDS = 800_000
#: Punctuation that may stand at the end of a word.
TAIL = b".,;:!?"
#: Words of Latin letters that are one code point and stay one in lower case.
PLAIN = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f]+")


def _byte_letters() -> list[str]:
    """How byte-level vocabularies write a byte: itself if it is a visible sign, else the next letter from 256."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in visible else chr(next(others)) for b in range(256)]


BYTE_LETTERS = _byte_letters()

HEADER = 17
FOOTER = 24


class Encoder:
    """Texts to serialised ids, the end id included.

    Where the tokenizer drops white space and takes what lies between by itself, a text is encoded
    piece by piece, and a word that was encoded before is looked up: invented or natural,
    most words of a text are old ones. A new word of Latin letters alone is given to the tokenizer's
    model at once, in the letters that stand for bytes there, if that was found to give the same
    for every such letter. Other tokenizers encode every text as a whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks use the cores
        self.tokenizer = tokenizers.Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.letter = {2: "H", 4: "I"}[self.width]
        self.end = self.serialised([END_ID])
        self.by_word = self._words_stand_alone()
        self.model = self.tokenizer.model
        self.letters = self.by_word and self._letters_are_bytes()
        self.folds, self.splits = self.by_word and self._case_is_ignored(), self.by_word and self._tails_stand_alone()
        self.known: dict[bytes, bytes] = {}

    def serialised(self, ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}{self.letter}", *ids)

    def ids(self, texts: list[str]) -> list[list[int]]:
        return [found.ids for found in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _words_stand_alone(self) -> bool:
        """Tried with words of many kinds on both sides of every white space that separates words."""
        kinds = ("Word", "w", "'s", "s", "12", "1", "...", "#a", "caf\u00e9", "\u0301", "\u03a3", "\u65e5\u672c", "\U0001f600", "<|", "|>")
        alone = dict(zip(kinds, self.ids(list(kinds))))
        texts = [(a, b, f"{gap}{a}{gap}{gap}{b}{gap}") for gap in " \t\n\v\f\r" for a in kinds for b in kinds]
        return all(found == alone[a] + alone[b] for (a, b, _), found in zip(texts, self.ids([t for *_, t in texts])))

    def _by_model(self, word: str) -> list[int]:
        word = word.lower()
        word = word if word.isascii() else "".join(map(BYTE_LETTERS.__getitem__, word.encode()))
        return [token.id for token in self.model.tokenize(word)]

    def _letters_are_bytes(self) -> bool:
        """Whether words of plain letters are one piece to the tokenizer, which its model takes byte by byte."""
        letters = [c for c in map(chr, range(0x180)) if PLAIN.fullmatch(c)]
        tried = [w for c in letters for w in (c, f"a{c}", f"{c}a", f"{c}{c}st")]
        return self.ids(tried) == [self._by_model(w) for w in tried]

    def _case_is_ignored(self) -> bool:
        letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
        return self.ids([letters, *letters]) == self.ids([letters.lower(), *letters.lower()])

    def _tails_stand_alone(self) -> bool:
        """Whether punctuation after an ASCII letter is a word of its own, at least at the end."""
        stems, tails = ("Word", "w", "'s", "n't", "1a", "#a", "\u00e9a"), (*TAIL.decode(), "...", "?!", ".,;")
        alone = {x: ids for x, ids in zip((*stems, *tails), self.ids([*stems, *tails]))}
        texts = [(a, b, a + b) for a in stems for b in tails]
        return all(found == alone[a] + alone[b] for (a, b, _), found in zip(texts, self.ids([t for *_, t in texts])))

    def _learn(self, found: list[bytes]) -> None:
        """Encode the words that are not known. A word is looked up in lower case, and apart from
        the punctuation at its end."""
        if len(self.known) > KNOWN_WORDS:
            self.known = {}
        known, waiting, texts = self.known, [], {}
        for word in set(found).difference(known):
            low = word.lower() if self.folds else word
            stem = low.rstrip(TAIL) if self.splits else low
            parts = (stem, low[len(stem) :]) if stem != low and stem[-1:].isalpha() else (low,)
            for part in parts:
                if part not in known:
                    text = part.decode("utf-8", "surrogatepass")
                    if self.letters and (part.isalpha() or PLAIN.fullmatch(text)):
                        known[part] = self.serialised(self._by_model(text))
                    else:
                        texts[part] = text
            if word != parts[0]:
                waiting.append((word, parts))
        for part, ids in zip(texts, self.ids(list(texts.values()))):
            known[part] = self.serialised(ids)
        for word, parts in waiting:
            known[word] = b"".join(map(known.__getitem__, parts))

    def text(self, text: str | None) -> bytes:
        if not self.by_word:
            return self.serialised(self.ids([text or ""])[0]) + self.end
        parts = []
        for piece in words.pieces((text or "").encode("utf-8", "surrogatepass")):
            found = piece.split()  # at the six bytes that separate words
            self._learn(found)
            parts.append(b"".join(map(self.known.__getitem__, found)))
        return b"".join((*parts, self.end))


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def restored(raw: bytes, width: int) -> np.ndarray:
    """Ids as little-endian unsigned integers of 32 bits."""
    return np.frombuffer(raw, dtype=f"<u{width}").astype("<u4")


def train_dictionary(samples: list[bytes]) -> bytes:
    """A dictionary for the sample; the sample itself where it is too small to train on."""
    if not any(samples):
        return b""
    size = min(DICTIONARY_BYTES, max(256, sum(map(len, samples)) // 8))
    try:
        return zstandard.train_dictionary(size, samples, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


def _dictionary(raw: bytes) -> zstandard.ZstdCompressionDict | None:
    """Made by training it says so itself; else any bytes will do."""
    return zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_AUTO) if raw else None


def compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    """The file names the dictionary, so frames need not."""
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=_dictionary(dictionary), write_dict_id=False)


def decompressor(dictionary: bytes) -> zstandard.ZstdDecompressor:
    return zstandard.ZstdDecompressor(dict_data=_dictionary(dictionary))


def opened(address: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The store of an address and the path in it."""
    if "://" not in address:  # file:/x, or a plain path
        return pyarrow.fs.LocalFileSystem(), address.removeprefix("file:")
    return pyarrow.fs.FileSystem.from_uri(address)


class Writer:
    """One file: frames as they come, then the index."""

    def __init__(self, folder: str, dictionary: bytes, width: int):
        store, path = opened(folder)
        self.name = f"ids-{uuid.uuid4().hex}.bin"
        self.out = store.open_output_stream(f"{path}/{self.name}")
        self.out.write(MAGIC + xxhash.xxh64(dictionary).intdigest().to_bytes(8, "little") + bytes([width]))
        self.bytes, self.ends, self.counts, self.names = 0, [], [], []

    def add(self, name: str | None, count: int, frame: bytes) -> None:
        self.out.write(frame)
        self.bytes += len(frame)
        self.ends.append(self.bytes)
        self.counts.append(count)
        self.names.append(None if name is None else name.encode("utf-8", "surrogatepass"))

    def close(self) -> tuple[str, int, int]:
        """The file's name, its documents and its ids."""
        parts = (
            np.array(self.ends, dtype="<u8").tobytes(),
            np.array(self.counts, dtype="<u4").tobytes(),
            np.array([-1 if n is None else len(n) for n in self.names], dtype="<i4").tobytes(),
            b"".join(n for n in self.names if n is not None),
        )
        index = zstandard.compress(b"".join(parts), LEVEL)
        self.out.write(index + len(self.ends).to_bytes(8, "little") + len(index).to_bytes(8, "little") + MAGIC)
        self.out.close()
        return self.name, len(self.ends), sum(self.counts)


class Reader:
    """A file's index, and any of its documents."""

    def __init__(self, folder: str, name: str, dictionary: bytes):
        store, path = opened(folder)
        self.file = store.open_input_file(f"{path}/{name}")
        size = self.file.size()
        head, foot = self.file.read_at(HEADER, 0), self.file.read_at(FOOTER, size - FOOTER)
        if head[:8] != MAGIC or foot[16:] != MAGIC:
            raise ValueError(f"{name} is no file of token ids")
        if int.from_bytes(head[8:16], "little") != xxhash.xxh64(dictionary).intdigest():
            raise ValueError(f"{name} was written with another dictionary")
        self.width = head[16]
        self.unpack = decompressor(dictionary)
        n, length = int.from_bytes(foot[:8], "little"), int.from_bytes(foot[8:16], "little")
        index = zstandard.decompress(self.file.read_at(length, size - FOOTER - length))
        self.ends = np.frombuffer(index, dtype="<u8", count=n)
        self.counts = np.frombuffer(index, dtype="<u4", count=n, offset=8 * n)
        self._sizes = np.frombuffer(index, dtype="<i4", count=n, offset=12 * n)
        self._names, self._at = index, 16 * n

    def __len__(self) -> int:
        return len(self.ends)

    def names(self) -> list[str | None]:
        ends = self._at + np.cumsum(np.maximum(self._sizes, 0))
        return [
            None if size < 0 else self._names[end - size : end].decode("utf-8", "surrogatepass")
            for size, end in zip(self._sizes.tolist(), ends.tolist())
        ]

    def ids(self, k: int) -> np.ndarray:
        """The ids of the k-th document, read from its frame alone."""
        start = int(self.ends[k - 1]) if k else 0
        frame = self.file.read_at(int(self.ends[k]) - start, HEADER + start)
        raw = self.unpack.decompress(frame, max_output_size=int(self.counts[k]) * self.width)
        return restored(raw, self.width)

    def stretches(self) -> Iterator[tuple[int, list[np.ndarray]]]:
        """All documents in order, as the number of the first one and the ids of each; one
        read for about READ_BYTES of frames."""
        a = 0
        while a < len(self):
            start = int(self.ends[a - 1]) if a else 0
            b = max(a + 1, int(np.searchsorted(self.ends, start + READ_BYTES, side="right")))
            raw = memoryview(self.file.read_at(int(self.ends[b - 1]) - start, HEADER + start))
            cuts = [0, *(self.ends[a:b].astype(np.int64) - start).tolist()]
            sizes = (self.counts[a:b].astype(np.int64) * self.width).tolist()
            yield a, [
                restored(self.unpack.decompress(raw[x:y], max_output_size=size), self.width)
                for x, y, size in zip(cuts[:-1], cuts[1:], sizes)
            ]
            a = b

    def close(self) -> None:
        self.file.close()


def _sample(docs: DataFrame, text_col: str, path: str) -> list[bytes]:
    """Serialised ids of about SAMPLE documents: SAMPLE * SAMPLE_IDS * 4 bytes at most."""
    n = docs.count()

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = map(encoder(path).text, batch["text"])
            yield pd.DataFrame({"raw": [x for x in found if len(x) <= SAMPLE_IDS * encoder(path).width]})

    chosen = docs.select(F.col(text_col).alias("text")).sample(min(1.0, SAMPLE / max(1, n)), seed=12)
    return [bytes(r["raw"]) for r in chosen.mapInPandas(encode, "raw binary").collect()]


def write(
    docs: DataFrame,
    folder: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer_path: str | None = None,
) -> bytes:
    """Encode all documents and write them below `folder` in order of their ids. Returns the
    dictionary, which is also written there."""
    spark = docs.sparkSession
    path = tokenizer_path or public_tokenizers.path("word_bpe_49k.json")
    width = encoder(path).width
    dictionary = train_dictionary(_sample(docs, text_col, path))
    store, inside = opened(folder)
    store.create_dir(inside, recursive=True)
    with store.open_output_stream(f"{inside}/dictionary.zdict") as out:
        out.write(dictionary)

    id_type = docs.select(F.col(id_col)).schema[0].dataType.simpleString()

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pack = compressor(dictionary)
        for batch in batches:
            for at in range(0, len(batch), TEXTS):
                some = batch.iloc[at : at + TEXTS]
                found = [encoder(path).text(t) for t in some["text"]]
                yield pd.DataFrame(
                    {
                        "name": some["name"].tolist(),
                        "row": some["row"].to_numpy(),
                        "n": [len(x) // width for x in found],
                        "frame": [pack.compress(x) for x in found],
                    }
                )

    numbered = docs.select(
        F.col(id_col).cast("string").alias("name"),
        F.monotonically_increasing_id().alias("row"),
        F.col(text_col).alias("text"),
    )
    # written, so that rows keep the number they were given when a later task is repeated
    frames = materialize(numbered.mapInPandas(encode, "name string, row long, n long, frame binary"), "id-frames")
    size = frames.agg(F.sum(F.length("frame")).alias("bytes")).first()["bytes"] or 0
    tasks = max(1, -(-size // FILE_BYTES), min(spread(spark), -(-size // LEAST_BYTES)))

    def put(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        part, seq, writer, files = TaskContext.get().partitionId(), 0, None, []
        for batch in batches:
            for name, n, frame in zip(batch["name"], batch["n"], batch["frame"]):
                writer = writer or Writer(folder, dictionary, width)
                writer.add(name, n, frame)
                if writer.bytes >= FILE_BYTES:
                    files.append((part, seq, *writer.close()))
                    writer, seq = None, seq + 1
        if writer:
            files.append((part, seq, *writer.close()))
        yield pd.DataFrame(files, columns=["part", "seq", "file", "documents", "ids"])

    key = F.col("name").cast(id_type)
    # the row number keeps an id that many documents share from being one range
    ordered = frames.withColumn("key", key).repartitionByRange(tasks, "key", "row").sortWithinPartitions("key", "row")
    told = materialize(
        ordered.select("name", "n", "frame").mapInPandas(put, "part int, seq int, file string, documents long, ids long"), "id-files"
    )
    rows = told.orderBy("part", "seq").collect()  # one row a file
    places = accumulate((r["ids"] for r in rows), initial=0)
    manifest = [(r["file"], r["documents"], r["ids"], place) for r, place in zip(rows, places)]
    spark.createDataFrame(manifest, "file string, documents long, ids long, start long").coalesce(1).write.parquet(f"{folder}/manifest")
    return dictionary


def read_dictionary(folder: str) -> bytes:
    store, inside = opened(folder)
    with store.open_input_stream(f"{inside}/dictionary.zdict") as file:
        return file.read()


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema("file string, documents long, ids long, start long").parquet(f"{folder}/manifest")


READ = "doc_id string, start long, n_tokens long, ids_crc32 long"


def read(spark: SparkSession, folder: str, id_type: str = "bigint") -> DataFrame:
    """One row per document, from the files alone: doc_id, start, n_tokens, ids_crc32.

    A stretch of frames is decompressed at a time; files are dealt to tasks.
    """
    dictionary = read_dictionary(folder)

    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for file, start in zip(batch["file"], batch["start"]):
                reader = Reader(folder, file, dictionary)
                starts = start + np.concatenate(([0], np.cumsum(reader.counts.astype(np.int64))))
                names = reader.names()
                for at, found in reader.stretches():
                    yield pd.DataFrame(
                        {
                            "doc_id": names[at : at + len(found)],
                            "start": starts[at : at + len(found)],
                            "n_tokens": [len(x) for x in found],
                            "ids_crc32": [zlib.crc32(x.tobytes()) for x in found],
                        }
                    )
                reader.close()

    files = read_manifest(spark, folder).select("file", "start")
    dealt = files.repartition(spread(spark), "file")
    return dealt.mapInPandas(look, READ).withColumn("doc_id", F.col("doc_id").cast(id_type))


def write_and_read(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", tokenizer_path: str | None = None
) -> DataFrame:
    """`write` to a new folder below the shared one, then `read`."""
    spark = docs.sparkSession
    folder = fresh_path(spark, "token-ids")
    write(docs, folder, id_col=id_col, text_col=text_col, tokenizer_path=tokenizer_path)
    return read(spark, folder, docs.select(F.col(id_col)).schema[0].dataType.simpleString())
