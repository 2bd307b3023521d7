import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from linkloom.llm import lexicon_bpe as lb
from linkloom.llm.queries import op10_lexicon_bpe, tokenizer_file

DEFINITION = open(tokenizer_file(), encoding="utf-8").read()
PIECES = ["a", "e", "th", "ing", "the", "é", "ü", " ", "  ", "\n", "\t", "\r\n", "\x85", "\xa0", " ", "　", "\x1c", "1", "23", "²", ".", ",", "!!", "'s", "'ll",
          "’", "<|endoftext|>", "<|", "😀", "👨‍👩‍👧", "日本", "한", "́", "​", "﻿", "\x00", "İ", "ß", "q" * 200, " hello", "word"]


def texts(seed, n=1500):
    r = random.Random(seed)
    return ["", " ", "ab" * 3000, " x" * 500] + ["".join(r.choice(PIECES) for _ in range(r.randint(0, 40))) for _ in range(n)]


def numbers(ids):
    return np.frombuffer(ids, "<u4").tolist()


def words_of(some):
    import regex

    find = regex.compile(lb.WORD_PATTERN).findall
    return sorted({w.encode() for t in some for w in find(t)})


@pytest.mark.parametrize("with_lexicon", [False, True])
def test_codec_equals_the_library(tmp_path, with_lexicon):
    lexicon = None
    if with_lexicon:
        rules = lb.Rules(DEFINITION)
        path = tmp_path / "lexicon.bin"
        path.write_bytes(lb.compile_lexicon({w: numbers(i) for w, i in rules.merge(words_of(texts(1)[::2])).items()}))
        lexicon = lb.Lexicon(str(path))
    codec, library = lb.Codec(DEFINITION, lexicon), Tokenizer.from_str(DEFINITION)
    some = texts(1)
    for text, ids, want in zip(some, codec.encode(some), library.encode_batch(some, add_special_tokens=False)):
        assert np.frombuffer(ids, "<u4").tolist() == want.ids, ascii(text)
        assert codec.decode(ids) == library.decode(want.ids, skip_special_tokens=False) == text
    broken = np.array([i for i, b in codec.rules.bytes_of.items() if len(b) == 1 and b[0] > 127][:40], "<u4")
    assert codec.decode(broken.tobytes()) == library.decode(broken.tolist(), skip_special_tokens=False)


def test_automaton_is_minimal_and_exact(tmp_path):
    r = random.Random(4)
    stems = ["".join(r.choice("abc") for _ in range(r.randint(1, 6))) for _ in range(200)]
    words = sorted({(s + e).encode() for s in stems for e in ("", "ing", "ation", "ations")})
    path = tmp_path / "l.bin"
    path.write_bytes(lb.compile_lexicon({w: [len(w), i] for i, w in enumerate(words)}))
    lexicon = lb.Lexicon(str(path))
    for w in words:
        assert [numbers(i) for i in lexicon.ids_of(lexicon.find([w]))] == [[len(w), words.index(w)]]
    there = set(words)
    for w in {w[:-1] for w in words} | {w + b"x" for w in words} | {b"zzz"}:
        if w and w not in there:
            assert lexicon.find([w])[0] == -1

    def rights(prefix):
        return frozenset(w[len(prefix):] for w in words if w.startswith(prefix))

    minimal = {rights(w[:k]) for w in words for k in range(len(w) + 1)}
    assert len(lexicon.final) == len(minimal)
    path.write_bytes(lb.compile_lexicon({}))
    assert lb.Lexicon(str(path)).find([b"a"]).tolist() == [-1]


def test_long_and_short_words_merge_alike():
    rules = lb.Rules(DEFINITION)
    r = random.Random(6)
    for n in (1, 2, 3, 17, 60):
        some = [bytes(r.choice(b"aeinst ") for _ in range(n)) for _ in range(50)]
        assert [numbers(x) for x in rules.merge_block(some)] == [rules.merge_long(w) for w in some]


def test_jobs(spark):
    rows = [(i if i % 7 else None, t, "x") for i, t in enumerate(texts(3, 300))] + [(1, None, "y"), (1, None, "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string").repartition(3)
    name = lb.fit_lexicon(df, DEFINITION, words=50)
    counts = {bytes(r.word): r.n for r in lb.word_counts(df).collect()}
    import regex
    from collections import Counter

    want = Counter(w.encode() for _, t, _ in rows for w in regex.findall(lb.WORD_PATTERN, t or ""))
    assert counts == want
    out = lb.decode_documents(lb.encode_documents(df, DEFINITION, name, ["doc_id"]), DEFINITION).collect()
    library = Tokenizer.from_str(DEFINITION)
    key = lambda x: (x[0] is None, x[0] or 0, x[1], x[2])
    expected = [(i, t or "", np.array(library.encode(t or "", add_special_tokens=False).ids, "<u4").tobytes()) for i, t, _ in rows]
    assert sorted(((r.doc_id, r.text, bytes(r.ids)) for r in out), key=key) == sorted(expected, key=key)
    empty = df.where("false")
    assert lb.encode_documents(empty, DEFINITION, lb.fit_lexicon(empty, DEFINITION), ["doc_id"]).count() == 0


def test_query_against_the_library(spark):
    import hashlib

    sf = "/root/testdata/sf0.001"
    library = Tokenizer.from_str(DEFINITION)
    want = {}
    for d in spark.read.parquet(f"{sf}/documents.parquet").collect():
        ids = library.encode(d.text or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        want[d.doc_id] = (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(back.encode()).hexdigest())
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in op10_lexicon_bpe(spark, sf).collect()} == want
