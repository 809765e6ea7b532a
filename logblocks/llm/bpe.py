"""Byte-level BPE by a prefix-sharing trie of distinct words.

The encoding of a prefix ends in one token, its last token; what stands before that token is itself the
encoding of a shorter prefix. So one number per trie node holds the encodings of all prefixes: the last token of
a node is the only token that ends there and stays apart from the last token of the node where it begins. Two
tokens stay apart if no merge joins across their border before both are whole.

A task cuts its texts into words by arrays over their characters, puts the distinct words that it has not met into a trie
and walks the trie depth-first, with the last tokens of the current path in one list. What words
share at their start is computed once. The trie is kept in preorder: its words sorted, each with the depth where it forks off.
The tokens that end at a node are known from the longest end of its path that begins a token. Python sees distinct words only;
their places in the texts stay in Arrow. Texts are taken in pieces of ``PIECE`` characters, so neither a long text nor
a long table fills the memory: a task holds the trie of one piece, about ``KNOWN`` finished words and the ids of
one batch. Of the finished words those that are met again stay. A worker that decodes holds the tokens' bytes only, nothing of an
encoder. There is no shuffle; the vocabulary (a few MB) is the only broadcast.

``encode`` gives ids, ``decode`` gives texts; both leave the other columns as they are. A null text counts as empty,
a null list of ids as empty; both give an empty result. Added tokens of the file are found in the text
first, longest first, as the file's library does; truncation and padding are not used. An empty table gives
an empty one. Repeated rows get equal answers. Bytes that form no character decode to U+FFFD.
"""

from __future__ import annotations

import functools
import json
import sys
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logblocks.shipping import ship

PIECE = 1 << 20  # characters whose words share a trie
KNOWN = 400_000  # words that a task remembers, with their ids packed
KNOWN_BYTES = 256  # longer words are not remembered
PAIRS = 1_000_000  # pairs of tokens, and of an ending and a byte, that a task remembers
BATCH_IDS = 1 << 20
LONG = 1 << 20  # characters; longer texts are taken in parts
NEVER = 1 << 62
HEAD = 32  # bytes that are compared together

# How byte-level BPE cuts a text into words, and the kinds of characters and shortened words in it.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SHORTENED = (("s", ""), ("t", ""), ("r", "e"), ("v", "e"), ("m", ""), ("l", "l"), ("d", ""))
LETTER, NUMBER, SPACE, OTHER = range(4)
# The end of a run of one kind, where a text can be cut in two whose words are found apart.
RUN_END = r"\p{L}(?!\p{L})|\p{N}(?!\p{N})|[^\s\p{L}\p{N}'](?=[\s\p{L}\p{N}])"


def byte_characters() -> dict[str, int]:
    """The character that stands for each byte: itself if printable, else the next free one from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(0x100 + k): b for k, b in enumerate(others)}


@functools.cache
def character_kinds() -> np.ndarray:
    """The kind of each code point."""
    kinds, every = np.full(sys.maxunicode + 1, OTHER, np.uint8), "".join(map(chr, range(sys.maxunicode + 1)))
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
        for run in regex.finditer(pattern, every):
            kinds[run.start() : run.end()] = kind
    return kinds


def cut_words(parts: list[tuple[str, bool]]) -> tuple[np.ndarray, pa.Array]:
    """Where the words begin, in characters of all parts together, and the words.

    All parts are cut at once, as ``SPLIT`` cuts each by itself; a part marked as whole is one word. Words are runs
    of one kind of characters. The last of some spaces before another run is a word of its own, or opens that run if it is U+0020.
    """
    text = "".join(part for part, _ in parts)
    if not text:
        return np.zeros(0, np.int64), pa.array([], pa.binary())
    data = text.encode()
    codes = np.frombuffer(data, np.uint8) if len(data) == len(text) else np.frombuffer(text.encode("utf-32-le"), np.uint32)
    kinds = character_kinds()[codes]
    opens = np.cumsum([0, *(len(part) for part, _ in parts)])
    first = np.zeros(len(codes) + 3, bool)  # of a part; those behind the end save a check
    first[opens] = True
    cut = first.copy()
    cut[1 : len(codes)] |= kinds[1:] != kinds[:-1]
    spaces = np.flatnonzero((kinds[:-1] == SPACE) & (kinds[1:] != SPACE))
    spaces = spaces[~first[spaces + 1]]
    cut[spaces] = True
    cut[spaces[codes[spaces] == ord(" ")] + 1] = False
    marks = np.flatnonzero(codes == ord("'"))
    marks = marks[cut[marks] & ~first[marks + 1]]  # where a word begins and its text goes on
    near = codes[marks + 1]
    far = np.where(first[marks + 2], 0, codes[np.minimum(marks + 2, len(codes) - 1)])
    for one, two in SHORTENED:
        hit = marks[(near == ord(one)) & (far == ord(two))] if two else marks[near == ord(one)]
        cut[hit + 1] = False
        cut[hit + len(one + two) + 1] = True
    for k, (_, whole) in enumerate(parts):
        if whole:
            cut[opens[k] + 1 : opens[k + 1]] = False
    starts = np.flatnonzero(cut[: len(codes)])
    offsets = starts
    if len(data) != len(text):
        sizes = 1 + (codes >= 0x80).astype(np.int8) + (codes >= 0x800) + (codes >= 0x10000)
        offsets = np.concatenate([[0], np.cumsum(np.add.reduceat(sizes, starts, dtype=np.int64))[:-1]])
    offsets = np.append(offsets, len(data)).astype(np.int32)
    return starts, pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


class Trie:
    """Distinct words as a trie in preorder: sorted, each with the depth at which it leaves the path of the word before it."""

    def __init__(self, words):
        self.words = sorted(words)
        heads = np.array(self.words, f"S{HEAD}").view(np.uint8).reshape(-1, HEAD)
        same = np.logical_and.accumulate(heads[1:] == heads[:-1], axis=1).sum(axis=1)
        sizes = np.array([*map(len, self.words)], np.int64)
        ends = np.minimum(sizes[1:], sizes[:-1])
        forks = np.append(np.zeros(min(len(sizes), 1), np.int64), np.minimum(same, ends))  # heads are filled up with zeros
        for k in np.flatnonzero((same == HEAD) & (ends > HEAD)).tolist():
            before, word, shared, end = self.words[k], self.words[k + 1], HEAD, int(ends[k])
            while shared < end and before[shared] == word[shared]:
                shared += 1
            forks[k + 1] = shared
        self.forks = forks.tolist()


class Spelling:
    """The bytes of each token, all that decoding needs."""

    def __init__(self, bytes_of: dict[int, bytes]):
        self.numbers = pa.array(sorted(bytes_of), pa.int32())
        self.spelled = pa.array([bytes_of[t] for t in sorted(bytes_of)], pa.binary())

    def decode(self, lists: pa.ListArray) -> pa.Array:
        """The text of each list of ids; null and unknown ids stand for nothing."""
        places = pc.index_in(lists.flatten(), self.numbers)  # null where unknown
        spelled = pc.fill_null(pc.take(self.spelled, places), b"")
        sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy()
        offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
        whole = pc.binary_join(pa.ListArray.from_arrays(offsets, spelled), b"")
        try:
            return whole.cast(pa.string())
        except pa.ArrowInvalid:  # bytes that form no character
            return pa.array([b.decode("utf-8", "replace") for b in whole.to_pylist()], pa.string())


class Vocabulary:
    """The tokens of a tokenizer file; other kinds of files are refused."""

    def __init__(self, file: bytes):
        spec = json.loads(file)
        self.model, added = spec["model"], spec.get("added_tokens") or []
        splitter, maker = spec.get("pre_tokenizer") or {}, spec.get("decoder") or {}
        odd = [k for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges") if self.model.get(k)]
        odd += [k for k in ("single_word", "lstrip", "rstrip") for token in added if token.get(k)]
        plain = splitter.get("type") == maker.get("type") == "ByteLevel" and splitter.get("use_regex", True)
        if self.model.get("type") != "BPE" or odd or not plain or splitter.get("add_prefix_space") or spec.get("normalizer"):
            raise ValueError(f"only plain byte-level BPE files are read {odd}")
        code = byte_characters()
        self.spelled = {token: bytes(code[c] for c in token) for token in self.model["vocab"] if all(c in code for c in token)}
        self.bytes_of = {number: self.spelled.get(token, token.encode()) for token, number in self.model["vocab"].items()}
        self.added = {token["content"]: token["id"] for token in added}
        self.bytes_of |= {number: text.encode() for text, number in self.added.items()}


class Coder:
    """The vocabulary of a tokenizer file, ready to encode and decode."""

    def __init__(self, file: bytes):
        read = Vocabulary(file)
        model, self.bytes_of, self.added = read.model, read.bytes_of, read.added
        self.added_pattern = regex.compile("|".join(regex.escape(t) for t in sorted(self.added, key=len, reverse=True))) if self.added else None
        self.run_end = regex.compile(RUN_END)
        self.spelling = Spelling(self.bytes_of)
        self._read_merges(model["vocab"], [m.split(" ") if isinstance(m, str) else m for m in model["merges"]], read.spelled)
        self.whole = {text.encode(): array("i", (number,)).tobytes() for text, number in self.added.items()}
        self.known, self.older = dict(self.whole), {}  # the packed ids of words met lately, and of those met before them

    def _read_merges(self, vocab: dict, merges: list, spelled: dict) -> None:
        self.rank, self.merged, self.parts = {}, {}, {}
        single = {spelled[t]: n for t, n in vocab.items() if len(spelled.get(t, b"")) == 1}
        if len(single) < 256:
            raise ValueError("the vocabulary lacks single bytes")
        made = set(single.values())
        for rank, (left, right) in enumerate(merges):
            a, b, whole = vocab[left], vocab[right], vocab[left + right]
            if not {a, b} <= made or whole in made:
                raise ValueError(f"merge {rank} is out of order")
            made.add(whole)
            self.merged[a, b] = rank
            self.rank[whole], self.parts[whole] = rank, (a, b)
        real = [w for w, (a, b) in self.parts.items() if self._stay_apart(a, b, self.rank[w])]  # else an earlier merge takes its bytes
        # a token's bytes to its number and, as they are met, whether it stays apart from a token on its left
        self.tokens = {self.bytes_of[t]: (t, {}) for t in (*single.values(), *real)}
        self.pairs = 0
        self.size = {t: len(spelled) for spelled, (t, _) in self.tokens.items()}
        self.beginnings = {spelled[:k] for spelled in self.tokens for k in range(len(spelled) + 1)}
        self.endings: dict[bytes, tuple] = {}

    def _ending(self, path: bytes) -> tuple:
        """The longest end of ``path`` that begins a token, by the next byte what follows it, and the tokens that end with it, longest first."""
        while path not in self.beginnings:
            path = path[1:]
        found = self.endings.get(path)
        if found is None:
            ends = [path[k:] for k in range(len(path)) if path[k:] in self.tokens]
            found = self.endings[path] = path, {}, [(len(end), *self.tokens[end]) for end in ends]
        return found

    def _edge(self, token: int, side: int) -> list[int]:
        """The tokens at one edge of ``token`` while it is built, the whole first, a byte last."""
        chain = [token]
        while (parts := self.parts.get(chain[-1])) is not None:
            chain.append(parts[side])
        return chain

    def _stay_apart(self, a: int, b: int, before: int = NEVER) -> bool:
        """Whether merges ranked below ``before`` build ``a`` and ``b`` side by side and never join them."""
        left, right = self._edge(a, 1), self._edge(b, 0)
        i, j = len(left) - 1, len(right) - 1
        while True:
            grow_left = self.rank[left[i - 1]] if i else NEVER
            grow_right = self.rank[right[j - 1]] if j else NEVER
            across = self.merged.get((left[i], right[j]), NEVER)
            if across < before and across < grow_left and across <= grow_right:  # of equal merges the left one comes first
                return False
            if not i and not j:
                return True
            if grow_left <= grow_right:
                i -= 1
            else:
                j -= 1

    def encode_words(self, words) -> dict[bytes, tuple[int, ...]]:
        """The ids of distinct words, by one depth-first walk through their trie.

        ``last[d]`` is the last token of the first d bytes of the path: of the tokens that end there the one that
        stays apart from the last token before it.
        """
        if self.pairs > PAIRS:
            for _, beside in self.tokens.values():
                beside.clear()
            self.endings.clear()
            self.pairs = 0
        last, endings, found, trie, sizes = [0], [self._ending(b"")], {}, Trie(words), self.size
        for word, fork in zip(trie.words, trie.forks):
            del last[fork + 1 :], endings[fork + 1 :]
            ending, end = endings[fork], fork
            for byte in word[fork:]:
                end += 1
                longer = ending[1].get(byte)
                if longer is None:
                    longer = ending[1][byte] = self._ending(ending[0] + bytes((byte,)))
                    self.pairs += 1
                ending = longer
                endings.append(ending)
                for size, token, beside in ending[2]:
                    if size < end:
                        before = last[end - size]
                        apart = beside.get(before)
                        if apart is None:
                            apart = beside[before] = self._stay_apart(before, token)
                            self.pairs += 1
                        if not apart:
                            continue
                    last.append(token)
                    break
            ids, end = [], len(word)
            while end:
                ids.append(last[end])
                end -= sizes[last[end]]
            found[word] = tuple(ids[::-1])
        return found

    def text_parts(self, text: str):
        """``(part, whether it is an added token)`` of a text in order; the parts are cut into words one by one."""
        start = 0
        for hit in self.added_pattern.finditer(text) if self.added_pattern else ():
            yield from self._runs(text, start, hit.start())
            yield hit.group(), True
            start = hit.end()
        yield from self._runs(text, start, len(text))

    def _runs(self, text: str, start: int, end: int):
        while end - start > LONG and (hit := self.run_end.search(text, start + LONG - 1, end)):
            yield text[start : hit.end()], False
            start = hit.end()
        if start < end:
            yield text[start:end], False

    def encode_piece(self, words) -> pa.ListArray:
        """The ids of each word; distinct words are looked up once, those that are new share one trie."""
        found = pa.array(words).cast(pa.binary()).dictionary_encode()
        distinct = found.dictionary.to_numpy(zero_copy_only=False).tolist()
        if len(self.known) > KNOWN // 2:  # what was not met since the last time goes
            self.known, self.older = dict(self.whole), self.known
        ids = [*map(self.known.get, distinct)]
        places = [k for k, packed in enumerate(ids) if packed is None]
        for k in places:
            ids[k] = self.older.get(distinct[k])
        fresh = self.encode_words([distinct[k] for k in places if ids[k] is None])
        for k in places:
            if ids[k] is None:
                ids[k] = array("i", fresh[distinct[k]]).tobytes()
            if len(distinct[k]) <= KNOWN_BYTES:
                self.known[distinct[k]] = ids[k]
        ends = np.cumsum([0, *map(len, ids)]) // 4
        lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(ids), np.int32)))
        return lists.take(found.indices)

    def encode_batch(self, texts):
        """``(number of the text, its ids)`` in order; the words of a piece come from many texts or a part of one."""
        piece, size, ends, before = [], 0, [], []

        def flush():
            nonlocal size, before
            starts, words = cut_words(piece)
            found = self.encode_piece(words)
            ids = found.flatten().to_numpy()
            borders = found.offsets.to_numpy()[np.searchsorted(starts, [end for _, end in ends])].tolist()
            start = 0
            for (number, _), border in zip(ends, borders):
                yield number, np.concatenate([*before, ids[start:border]]) if before else ids[start:border]
                before, start = [], border
            before.append(ids[start:])
            piece.clear()
            ends.clear()
            size = 0

        for number, text in enumerate(texts):
            for part in self.text_parts(text or ""):
                piece.append(part)
                size += len(part[0])
                if size >= PIECE:
                    yield from flush()
            ends.append((number, size))
            if len(ends) >= PIECE:
                yield from flush()
        yield from flush()

    def decode(self, lists: pa.ListArray) -> pa.Array:
        return self.spelling.decode(lists)


@functools.lru_cache(maxsize=2)
def _coder(file: bytes) -> Coder:
    return Coder(file)


@functools.lru_cache(maxsize=2)
def _read_spelling(file: bytes) -> Spelling:
    return Spelling(Vocabulary(file).bytes_of)


def _spelling(file: bytes) -> Spelling:
    """For a worker that decodes; what it remembers from encoding before goes."""
    _coder.cache_clear()
    return _read_spelling(file)


def _mapped(docs: DataFrame, path: str, column: str, kind: T.DataType, read, fn) -> DataFrame:
    """``docs`` with ``column`` set to what ``fn(read(file), batch)`` yields: arrays for the first, next, ... rows."""
    spark = docs.sparkSession
    ship(spark)
    with open(path, "rb") as source:
        shared = spark.sparkContext.broadcast(source.read())
    kept = [f for f in docs.schema.fields if f.name != column]

    def body(batches):
        coder = read(shared.value)
        for batch in batches:
            done = 0
            for found in fn(coder, batch):
                part = batch.slice(done, len(found))
                yield pa.RecordBatch.from_arrays([*(part.column(f.name) for f in kept), found], [*(f.name for f in kept), column])
                done += len(found)

    return docs.mapInArrow(body, T.StructType([*kept, T.StructField(column, kind)]))


def encode(docs: DataFrame, path: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """``docs`` with the ids of each text in ``ids_col``; ``path`` names a tokenizer file that the driver can read."""

    def ids_of(coder: Coder, batch):
        found, offsets = [], [0]
        for _, ids in coder.encode_batch(t.as_py() for t in batch.column(text_col)):
            found.append(ids)
            offsets.append(offsets[-1] + len(ids))
            if offsets[-1] >= BATCH_IDS:
                yield pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(found)))
                found, offsets = [], [0]
        if found:
            yield pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(found)))

    return _mapped(docs, path, ids_col, T.ArrayType(T.IntegerType()), _coder, ids_of)


def decode(rows: DataFrame, path: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """``rows`` with the text that each list of ids stands for; a null or unknown id stands for nothing."""

    def texts_of(coder: Spelling, batch):
        for start in range(0, batch.num_rows, 256):
            yield coder.decode(batch.column(ids_col).slice(start, 256))

    return _mapped(rows, path, text_col, T.StringType(), _spelling, texts_of)


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every document: encoded, then decoded from the ids."""
    both = decode(encode(docs.select("doc_id", "text"), path).drop("text"), path)
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        sha256(F.array_join(F.col("ids").cast("array<string>"), ",")).alias("ids_sha256"),
        sha256(F.col("decoded")).alias("decoded_sha256"),
    )
