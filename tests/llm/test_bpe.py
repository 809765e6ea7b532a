"""Byte-level BPE against the tokenizers library on whole tables and on odd texts."""

import hashlib
import random
from itertools import accumulate

import public_tokenizers
import pyarrow as pa
import pytest
import regex
from tokenizers import Tokenizer

from logblocks.llm import bpe
from logblocks.llm.common import table
from logblocks.llm.queries import registered

PATH = public_tokenizers.path("byte_bpe_50k.json")
KIND = "doc_id long, text string, ids string, decoded string, n_tokens int"

ODD = [
    None, "", " ", "a<|endoftext|>  b   <|endoftext|>\n\n x", "<|endoftext|>", "aaaaaaaaaaaaaaaaaaa" * 9, " \n \n\n  \t x's 'll'll I'LL",
    "x" * 3000, "ab" * 2000, "=-" * 2000, "日本語テキスト" * 40, "\u0000\u0001\u007f­Ā", "é \U0001f469‍\U0001f52c 12 ½", "a", "a",
]


@pytest.fixture(scope="module")
def library():
    found = Tokenizer.from_file(PATH)
    found.no_truncation()
    found.no_padding()
    return found


@pytest.fixture(scope="module")
def coder():
    with open(PATH, "rb") as file:
        return bpe.Coder(file.read())


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def expected(library, doc_id, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    return doc_id, len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))


def test_every_document_as_the_library_does(spark, library):
    sf_dir = "/root/testdata/sf0.01"
    got = {tuple(r) for r in registered()["op11_bpe"](spark, sf_dir).collect()}
    rows = table(spark, sf_dir, "documents").select("doc_id", "text").collect()
    assert got == {expected(library, *r) for r in rows} and len(got) == len(rows)


def test_odd_rows_and_clashing_columns(spark, library):
    rows = [(k if k else None, text, "x", "y", 3) for k, text in enumerate(ODD)]
    docs = spark.createDataFrame(rows + rows[-1:], KIND)
    got = sorted(map(tuple, bpe.round_trip(docs, PATH).collect()), key=repr)
    assert got == sorted((expected(library, r[0], r[1]) for r in rows + rows[-1:]), key=repr)
    assert bpe.round_trip(spark.createDataFrame([], KIND), PATH).count() == 0
    kept = bpe.encode(docs, PATH)  # other columns stay, a column of the result's name is replaced
    assert sorted(kept.columns) == sorted(docs.columns) and dict(kept.dtypes)["ids"] == "array<int>"


def test_null_and_unknown_ids(spark):
    rows = spark.createDataFrame([(1, None), (2, []), (3, [64, None, 999_999, 65]), (4, [127, 50256])], "k long, ids array<int>")
    got = {r["k"]: r["decoded"] for r in bpe.decode(rows, PATH).collect()}
    assert (got[1], got[2], got[3]) == ("", "", "ab")
    assert got[4] == "\ufffd<|endoftext|>"  # a byte that is no character by itself


def test_random_texts_and_small_pieces(library, coder, monkeypatch):
    rng = random.Random(3)
    texts = ["".join(rng.choice("aehitnos \n'1é=-<|>") for _ in range(rng.randint(0, 90))) for _ in range(3000)]
    texts += [t for t in ODD if t]
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    for piece, long in ((1 << 18, 1 << 20), (7, 4)):  # pieces end within texts, long texts are cut one by one
        monkeypatch.setattr(bpe, "PIECE", piece)
        monkeypatch.setattr(bpe, "LONG", long)
        monkeypatch.setattr(bpe, "KNOWN", 50)
        got = list(coder.encode_batch(texts))
        assert [k for k, _ in got] == list(range(len(texts)))
        assert [list(ids) for _, ids in got] == want


def test_characters_of_every_kind(library, coder):
    chars = [chr(k) for k in range(0x3100) if not 0xD800 <= k < 0xE000] + [chr(k) for k in range(0x1F000, 0x1FA00, 7)]
    texts = [f"a{c}b {c}{c} 1{c} {c}" for c in chars]
    assert [list(ids) for _, ids in coder.encode_batch(texts)] == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def merged(coder, word):
    """Merge by merge, the lowest rank first, the leftmost of equal ones."""
    ids = [coder.tokens[bytes([b])][0] for b in word]
    while True:
        ranks = [(coder.merged.get(pair, bpe.NEVER), k) for k, pair in enumerate(zip(ids, ids[1:]))]
        if not ranks or min(ranks)[0] == bpe.NEVER:
            return ids
        k = min(ranks)[1]
        whole = next(t for t, parts in coder.parts.items() if parts == (ids[k], ids[k + 1]))
        ids[k : k + 2] = [whole]


def test_every_prefix_is_merged_as_brute_force_does(coder):
    for word in (b" internationalisation", b"aaaaaaaaaaaaa", b"-=-=-=-=", " größte".encode()):
        prefixes = {word[:k] for k in range(1, len(word) + 1)}
        assert coder.encode_words(prefixes) == {p: tuple(merged(coder, p)) for p in prefixes}


def test_trie_forks_where_words_part():
    words = [b"a", b"ab", b"abc", b"abd", b"b", b"b\0", b"xyz" * 20, b"xyz" * 20 + b"a", b"xyz" * 20 + b"b"]
    for order in (words, words[::-1]):
        trie = bpe.Trie(order)
        assert trie.words == words and trie.forks == [0, 1, 2, 2, 0, 1, 0, 60, 60]
    assert bpe.Trie([]).words == []


def test_other_kinds_of_files_are_refused():
    with open(public_tokenizers.path("word_bpe_49k.json"), "rb") as file, pytest.raises(ValueError):
        bpe.Coder(file.read())


def test_a_worker_that_decodes_drops_its_encoder(coder):
    with open(PATH, "rb") as file:
        content = file.read()
    bpe._coder(content).encode_piece(["some", " words"])
    spelling = bpe._spelling(content)
    assert bpe._coder.cache_info().currsize == 0 and set(vars(spelling)) == {"numbers", "spelled"}
    assert bpe._spelling(content) is spelling
    ids = pa.array([list(coder.encode_piece([" words"])[0]), None, [-1]], pa.list_(pa.int32()))
    assert spelling.decode(ids).to_pylist() == [" words", "", ""]


def test_texts_are_cut_as_the_pattern_does():
    rng = random.Random(5)
    letters = "srvemtlldS'' \n\t\xa0\x1c\u20281é½!-日\U0001f469"
    parts = [("".join(rng.choice(letters) for _ in range(rng.randint(1, 12))), False) for _ in range(20_000)]
    parts += [("' 's  'll\n've 'r 'e", False), ("<|x 's|>", True), (" ", False), ("'", False), ("s", False)]
    for some in (parts, [("it's  we'll", False), (" 'tis", False)], []):
        want = [w for part, whole in some for w in ([part] if whole else regex.findall(bpe.SPLIT, part))]
        starts, words = bpe.cut_words(some)
        assert [w.decode() for w in words.to_pylist()] == want
        assert starts.tolist() == [0, *accumulate(map(len, want))][: len(want)]


def test_words_that_return_are_walked_once(coder, monkeypatch):
    walked = []
    walk = coder.encode_words
    monkeypatch.setattr(coder, "encode_words", lambda words: walked.extend(words) or walk(words))
    monkeypatch.setattr(bpe, "KNOWN", 40)
    monkeypatch.setattr(bpe, "PIECE", 100)
    texts = [f"zqreturning vx{k}yw" for k in range(200)]  # new words fill the memory again and again
    assert len(list(coder.encode_batch(texts))) == 200
    assert len(coder.known) + len(coder.older) < 100 and walked.count(b"zqreturning") == 1


def test_texts_without_words(coder):
    assert [(k, list(ids)) for k, ids in coder.encode_batch([None, "", ""])] == [(0, []), (1, []), (2, [])]
    assert list(coder.encode_batch([])) == []


def test_a_worker_that_decodes_builds_no_encoder(coder, monkeypatch):
    def refuse(file):
        raise AssertionError("only the tokens' bytes are needed")

    monkeypatch.setattr(bpe, "Coder", refuse)
    bpe._read_spelling.cache_clear()
    with open(PATH, "rb") as file:
        spelling = bpe._spelling(file.read())
    assert spelling.numbers == coder.spelling.numbers and spelling.spelled == coder.spelling.spelled
    with open(public_tokenizers.path("word_bpe_49k.json"), "rb") as file, pytest.raises(ValueError):
        bpe._spelling(file.read())


def test_what_the_walk_remembers_is_bounded(coder, monkeypatch):
    monkeypatch.setattr(bpe, "PAIRS", 50)
    for k in range(3):
        words = [f"walk{k}ing thr{j}ough \u00e9t\u00e9s" for j in range(20)]
        found = coder.encode_words({w.encode() for w in words})
        assert [list(found[w.encode()]) for w in words] == [merged(coder, w.encode()) for w in words]
        assert coder.pairs > 50  # so the next walk starts anew
    coder.encode_words([])
    assert coder.pairs == 0 and set(coder.endings) == {b""} and not any(beside for _, beside in coder.tokens.values())
