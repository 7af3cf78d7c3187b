"""BPE encoding with a minimal acyclic transducer of frequent words.

Words are counted over all texts. The most frequent ones are compiled into a minimal acyclic
automaton over their UTF-8 bytes: words share prefixes and suffixes, and the number of words that
end before an arc leads each word to its own place in a table of ids. The automaton is one file,
written below the shared folder, sent to the executors by Spark and memory-mapped by their workers.
Words outside it are merged exactly, lowest rank first and leftmost among equals. How many words
are compiled changes only the speed, never an id.

The tokenizer file is read by the driver and broadcast; its size is bounded by its vocabulary.
Null texts count as empty; they and blank texts have no ids. Texts of any length are taken whole.
Other columns are kept; columns named ids, n_tokens or decoded are replaced.
"""

from __future__ import annotations

import bisect
import heapq
import itertools
import json
import mmap
import struct
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from repopulse.session import shared_folder

#: Characters that str.split() takes for blanks and the tokenizer does not.
_NOT_BLANK = regex.compile("[\x1c-\x1f]")
_BLANKS = regex.compile(r"[^\S\x1c-\x1f]+")
#: Words, and chunks of other than plain words, that a worker keeps the ids of; its memory stays bounded on any text.
CACHED = 300_000
CACHED_CHUNKS = 50_000
#: Bytes of the longest word of the lexicon, and bytes of text that are split and encoded at once, which bounds a worker's arrays.
LONGEST = 64
SLICE_BYTES = 2 << 20


def _byte_letters() -> list[str]:
    """The letter that stands for each byte: visible Latin-1 characters for themselves, the rest from U+0100 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


@dataclass
class Bpe:
    """Vocabulary, merges and splitting rule of a word-level BPE with word ends and without a decoder."""

    vocab: dict[str, int]
    ranks: dict[tuple[str, str], int]
    pattern: str
    special: dict[str, int]
    word_end: str

    @classmethod
    def from_file(cls, path: str) -> Bpe:
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        model = content["model"]
        splits = [p["pattern"]["Regex"] for p in content["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split"]
        kinds = [n["type"] for n in content["normalizer"]["normalizers"]]
        if model["type"] != "BPE" or len(splits) != 1 or kinds != ["NFC", "Replace", "Lowercase"] or content["decoder"]:
            raise ValueError(f"{path} is not a tokenizer of this kind")
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        return cls(
            model["vocab"],
            {pair: rank for rank, pair in enumerate(pairs)},
            splits[0],
            {t["content"]: t["id"] for t in content["added_tokens"]},
            model["end_of_word_suffix"] or "",
        )

    def __post_init__(self) -> None:
        self._letters = _byte_letters()
        self._split = regex.compile(self.pattern)
        self._special = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self._openers = {t[0] for t in self.special}
        # Marks that the splitting rule parts from the letters before them, whatever follows.
        self._marks = tuple(m for m in ".,;:!?" if m not in self._openers and self._split.findall(f"ab{m}") == ["ab", m])
        self.tokens = {i: t for t, i in (self.vocab | self.special).items()}

    def _may_be_special(self, chunk: str) -> bool:
        return any(c in chunk for c in self._openers)

    def plain(self, chunk: str) -> tuple[str, ...]:
        """The words of a chunk of ASCII letters with at most one mark behind them; none for other chunks."""
        if chunk.isascii():
            if chunk.isalpha():
                return (chunk.lower(),)
            if chunk[-1:] in self._marks and chunk[:-1].isalpha():
                return chunk[:-1].lower(), chunk[-1]
        return ()

    def pieces(self, chunk: str) -> list[tuple[str, bool]]:
        """The words of a text without blanks, and whether each is a special token."""
        if words := self.plain(chunk):
            return [(word, False) for word in words]
        found = []
        for k, part in enumerate(self._special.split(chunk) if self._may_be_special(chunk) else [chunk]):
            if k % 2:
                found.append((part, True))
            elif part:
                # Each character is lowered by itself: a sigma at a word's end is no exception.
                plain = part.lower() if part.isascii() else unicodedata.normalize("NFC", part).replace("Σ", "σ").lower()
                found += [(word, False) for word in self._split.findall(plain)]
        return found

    def merge(self, word: str) -> list[int]:
        """Ids of one word by its merges."""
        parts = [self._letters[b] for b in word.encode("utf-8")]
        parts[-1] += self.word_end
        if len(parts) > 64:
            return self._merge_long(parts)
        get, none = self.ranks.get, len(self.ranks)
        found = [get(pair, none) for pair in itertools.pairwise(parts)]
        while found and (best := min(found)) < none:
            i = found.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del found[i]
            if i:
                found[i - 1] = get((parts[i - 1], parts[i]), none)
            if i < len(found):
                found[i] = get((parts[i], parts[i + 1]), none)
        return [self.vocab[p] for p in parts]

    def _merge_long(self, parts: list[str | None]) -> list[int]:
        """The same in the same order, with the pairs in a queue: the time grows little more than the word."""
        after = [*range(1, len(parts)), -1]
        before = list(range(-1, len(parts) - 1))
        ranks = self.ranks
        queue = [(ranks[pair], i) for i, pair in enumerate(zip(parts, parts[1:])) if pair in ranks]
        heapq.heapify(queue)
        while queue:
            rank, i = heapq.heappop(queue)
            j = after[i] if parts[i] is not None else -1
            if j < 0 or ranks.get((parts[i], parts[j])) != rank:
                continue
            parts[i] += parts[j]
            parts[j] = None
            after[i] = after[j]
            if after[i] >= 0:
                before[after[i]] = i
            for left, right in ((before[i], i), (i, after[i])):
                if left >= 0 and right >= 0 and (found := ranks.get((parts[left], parts[right]))) is not None:
                    heapq.heappush(queue, (found, left))
        return [self.vocab[p] for p in parts if p is not None]


class _State:
    __slots__ = ("arcs", "final", "number")

    def __init__(self) -> None:
        self.arcs: list[tuple[int, _State]] = []
        self.final = False
        self.number = -1

    def key(self) -> tuple:
        return (self.final, *((label, id(to)) for label, to in self.arcs))


def compile_lexicon(words: Iterable[str], ids_of) -> bytes:
    """The automaton of distinct words and the ids of each, as one block of bytes.

    Words are added in byte order; when the next word leaves a branch, the branch's states are
    replaced by equal ones that exist already.
    """
    ordered = sorted({w.encode("utf-8") for w in words if w})
    root, known = _State(), {}
    path: list[_State] = [root]

    def close(down_to: int) -> None:
        while len(path) > down_to + 1:
            state = path.pop()
            label, _ = path[-1].arcs[-1]
            path[-1].arcs[-1] = (label, known.setdefault(state.key(), state))

    last = b""
    for word in ordered:
        same = next((k for k, (a, b) in enumerate(zip(last, word)) if a != b), min(len(last), len(word)))
        close(same)
        for byte in word[same:]:
            state = _State()
            path[-1].arcs.append((byte, state))
            path.append(state)
        path[-1].final = True
        last = word
    close(0)

    states, stack = [], [root]
    while stack:
        state = stack.pop()
        if state.number < 0:
            state.number = len(states)
            states.append(state)
            stack.extend(to for _, to in state.arcs)
    below: dict[int, int] = {}
    pending = list(states)
    while pending:  # words below each state; a state waits for those that its arcs lead to
        state = pending.pop()
        if state.number in below:
            continue
        missing = [to for _, to in state.arcs if to.number not in below]
        if missing:
            pending += [state, *missing]
        else:
            below[state.number] = state.final + sum(below[to.number] for _, to in state.arcs)
    first, labels, targets, skips = [0], [], [], []
    for state in states:
        passed = int(state.final)
        for label, to in state.arcs:
            labels.append(label)
            targets.append(to.number)
            skips.append(passed)
            passed += below[to.number]
        first.append(len(labels))
    encoded = [ids_of(w.decode("utf-8")) for w in ordered]
    offsets = np.cumsum([0, *map(len, encoded)])
    parts = [
        np.array(first, "<i4"),
        np.array([s.final for s in states], "<i4"),
        np.array(labels, "<i4"),
        np.array(targets, "<i4"),
        np.array(skips, "<i4"),
        offsets.astype("<i4"),
        np.array([i for ids in encoded for i in ids], "<i4"),
    ]
    return struct.pack("<7i", *map(len, parts)) + b"".join(p.tobytes() for p in parts)


class Lexicon:
    """A compiled automaton, memory-mapped from its file."""

    def __init__(self, path: str) -> None:
        with open(path, "rb") as file:
            mapped = memoryview(mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)).cast("i")
        ends = [7, *itertools.accumulate(mapped[:7], initial=7)][1:]
        parts = [mapped[a:b] for a, b in itertools.pairwise(ends)]
        self.first, self.final, self.labels, self.targets, self.skips, self.offsets, self.ids = parts

    def find(self, word: str) -> list[int] | None:
        first, labels, targets, skips = self.first, self.labels, self.targets, self.skips
        state = place = 0
        for byte in word.encode("utf-8"):
            end = first[state + 1]
            at = bisect.bisect_left(labels, byte, first[state], end)
            if at == end or labels[at] != byte:
                return None
            place += skips[at]
            state = targets[at]
        if not self.final[state]:
            return None
        return self.ids[self.offsets[place] : self.offsets[place + 1]].tolist()


    def entries(self) -> dict[str, list[int]]:
        """All words and their ids, by one walk through the automaton in the order of their places."""
        first, final, labels, targets = (x.tolist() for x in (self.first, self.final, self.labels, self.targets))
        offsets, ids, found = self.offsets.tolist(), self.ids.tolist(), {}
        stack = [(0, b"")]
        while stack:
            state, word = stack.pop()
            if final[state]:
                found[word.decode("utf-8")] = ids[offsets[len(found)] : offsets[len(found) + 1]]
            stack += [(targets[at], word + bytes((labels[at],))) for at in range(first[state + 1] - 1, first[state] - 1, -1)]
        return found


def _chunks(text: str) -> list[str]:
    if _NOT_BLANK.search(text):
        return [c for c in _BLANKS.split(text) if c]
    return text.split()


def _slices(texts: pa.Array) -> Iterator[tuple[int, pa.Array]]:
    """Begin and texts of runs of rows of about ``SLICE_BYTES`` bytes; a longer text is a run of its own. Nulls become empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    begin = 0
    while begin < len(texts):
        done = int(ends[begin - 1]) if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, done + SLICE_BYTES, side="right")))
        yield begin, texts.slice(begin, end - begin)
        begin = end


def _split(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """All chunks of the texts, coded by their distinct values, and the place behind each text's last one; some may be empty."""
    if pc.any(pc.match_substring_regex(texts, "[\x1c-\x1f]")).as_py():
        lists = [_chunks(t) for t in texts.to_pylist()]
        flat, ends = pa.array([c for x in lists for c in x], pa.large_string()), np.cumsum([len(x) for x in lists])
    else:
        found = pc.utf8_split_whitespace(texts)
        flat, ends = found.flatten(), np.cumsum(pc.list_value_length(found).to_numpy(zero_copy_only=False))
    return flat.dictionary_encode(), ends.astype(np.int64)


def count_words(docs: DataFrame, bpe: Bpe, text: str = "text", most_docs: int | None = None) -> DataFrame:
    """word, n: how often each word of up to 64 bytes occurs in all texts.

    It decides which words the lexicon holds, that is the work of the encoder, and never an id: words
    beyond it are merged exactly. A task sends each word once for each batch of rows that holds it.
    ``most_docs``, which :func:`encode` does not use, counts about so many texts instead, taken by their hash.
    """
    shared = docs.sparkSession.sparkContext.broadcast(bpe)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words: Counter = Counter()
            for _, texts in _slices(batch.column(0)):
                coded, _ = _split(texts)
                counts = np.bincount(coded.indices.to_numpy(), minlength=len(coded.dictionary)).tolist()
                for chunk, n in zip(coded.dictionary.to_pylist(), counts, strict=True):
                    for word, special in shared.value.pieces(chunk):
                        if not special and len(word.encode()) <= LONGEST:
                            words[word] += n
                if len(words) >= CACHED:
                    yield counted(words)
                    words = Counter()
            yield counted(words)

    def counted(words: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"word": pa.array(words.keys(), pa.string()), "n": pa.array(words.values(), pa.int64())})

    plain = docs.select(F.col(text).alias("t")).where(F.col("t").isNotNull())
    if most_docs is not None and (every := plain.count()) > most_docs:
        plain = plain.where(F.pmod(F.xxhash64("t"), F.lit(1 << 20)) < max(1, (most_docs << 20) // every))
    return plain.mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def build_lexicon(spark: SparkSession, words: DataFrame, bpe: Bpe, size: int) -> str:
    """Compile the ``size`` most frequent words; returns the name under which workers find the file.

    ``size`` words of up to 64 bytes bound what reaches the driver and what the automaton holds.
    """
    short = words.where(F.octet_length("word") <= LONGEST)
    top = [r["word"] for r in short.orderBy(F.desc("n"), "word").limit(size).select("word").toLocalIterator()]
    block = compile_lexicon(top, bpe.merge)
    folder = shared_folder(spark)
    name = f"lexicon-{folder.rpartition('/')[2]}.bin"
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}")
    out = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path)
    out.write(bytearray(block))
    out.close()
    spark.sparkContext.addFile(path.toString())
    return name


class Encoder:
    """Encodes texts in one worker; the ids of words and of other chunks between blanks are kept up to a bound.

    The words of the lexicon, whose number is bounded, are read from its automaton at once.
    """

    def __init__(self, bpe: Bpe, lexicon: Lexicon) -> None:
        self.bpe, self.lexicon = bpe, {word: _packed(ids) for word, ids in lexicon.entries().items()}
        self._tokens = pa.array([bpe.tokens.get(i) for i in range(max(bpe.tokens) + 1)], pa.string())
        self._words: dict[str, bytes] = {}
        self._chunks: dict[str, bytes] = {}

    @staticmethod
    def _keep(kept: dict[str, bytes], key: str, ids: bytes, most: int) -> None:
        if len(kept) >= most:
            kept.clear()
        if len(key) <= LONGEST:
            kept[key] = ids

    def word(self, word: str) -> bytes:
        ids = self.lexicon.get(word)
        if ids is None:
            ids = self._words.get(word)
            if ids is None:
                ids = _packed(self.bpe.merge(word))
                self._keep(self._words, word, ids, CACHED)
        return ids

    def chunk(self, chunk: str) -> bytes:
        """Ids as little-endian 32-bit integers. Chunks of plain words are put together, not kept beside their words."""
        if words := self.bpe.plain(chunk):
            return self.word(words[0]) if len(words) == 1 else self.word(words[0]) + self.word(words[1])
        ids = self._chunks.get(chunk)
        if ids is None:
            ids = b"".join(_packed([self.bpe.special[word]]) if special else self.word(word) for word, special in self.bpe.pieces(chunk))
            self._keep(self._chunks, chunk, ids, CACHED_CHUNKS)
        return ids

    def texts(self, texts: pa.Array) -> list[pa.Array]:
        """n_tokens, ids and decoded of whole texts; what is found once for a chunk is laid out for all its places."""
        coded, ends = _split(texts)
        codes = coded.indices.to_numpy()
        found = [self.chunk(c) for c in coded.dictionary.to_pylist()]
        pool = np.frombuffer(b"".join(found), "<u4")
        sizes = np.fromiter((len(f) // 4 for f in found), np.int64, len(found))
        begins = np.cumsum(sizes) - sizes
        counts = sizes[codes]
        upto = np.concatenate(([0], np.cumsum(counts)))
        ids = pool[np.repeat(begins[codes] - upto[:-1], counts) + np.arange(upto[-1])]
        tokens = upto[np.concatenate(([0], ends))]
        blobs = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(4 * tokens), pa.py_buffer(ids)])
        # Without a decoder, tokens are joined by blanks.
        shown = pa.ListArray.from_arrays(pa.array(tokens, pa.int32()), self._tokens.take(pa.array(ids)))
        return [pa.array(np.diff(tokens), pa.int64()), blobs.cast(pa.binary()), pc.binary_join(shown, " ")]


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def encode(docs: DataFrame, tokenizer_path: str, lexicon_size: int = 20_000, text: str = "text") -> DataFrame:
    """Add n_tokens, ids (little-endian unsigned 32-bit integers) and decoded to every row."""
    spark = docs.sparkSession
    bpe = Bpe.from_file(tokenizer_path)
    name = build_lexicon(spark, count_words(docs, bpe, text), bpe, lexicon_size)
    shared = spark.sparkContext.broadcast(bpe)
    kept = [c for c in docs.columns if c not in ("n_tokens", "ids", "decoded")]
    frame = docs.select(*kept)
    at = kept.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shared.value, Lexicon(SparkFiles.get(name)))
        for batch in batches:
            for begin, texts in _slices(batch.column(at)):
                part = batch.slice(begin, len(texts))
                yield pa.RecordBatch.from_arrays([*part.columns, *encoder.texts(texts)], [*kept, "n_tokens", "ids", "decoded"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in frame.schema.fields)
    return frame.mapInArrow(run, f"{fields}, n_tokens bigint, ids binary, decoded string")
