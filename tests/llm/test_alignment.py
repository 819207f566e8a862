import hashlib
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from skyledger.llm import alignment
from skyledger.llm.alignment import groups as groups_as_text
from skyledger.llm.alignment import align, block_rows, byte_letters, loaded, op13_token_alignment, pair_counts, words_of

FIELDS = "doc_id long, text string"
ZERO = (0, 0, 0, 0, 0, 0, "")


def groups(pair, text):
    """The groups of a whole text, by encoding it at once."""
    if not text:
        return []
    whole = (" " + text).encode()
    a, b = pair.a.encode(" " + text, add_special_tokens=False).ids, pair.b.encode(text)
    if b"".join(pair.a_bytes[i] for i in a) != whole or b"".join(pair.b_bytes[i] for i in b) != whole:
        return []
    out, x, y, at_x, at_y = [([], [])], 0, 0, 0, 0
    while x < len(a) or y < len(b):
        if at_x <= at_y and x < len(a):
            out[-1][0].append(a[x])
            at_x, x = at_x + len(pair.a_bytes[a[x]]), x + 1
        else:
            out[-1][1].append(b[y])
            at_y, y = at_y + len(pair.b_bytes[b[y]]), y + 1
        if at_x == at_y:
            out.append(([], []))
    assert out.pop() == ([], [])
    return out


def brute(rows):
    pair = loaded(None, None)
    found = [(i, groups(pair, t)) for i, t in rows]
    count = Counter(p for _, g in found for p in {(a, b) for x, y in g for a in x for b in y})
    best = defaultdict(int)
    for (a, _), n in count.items():
        best[a] = max(best[a], n)
    out = []
    for i, g in found:
        links = [(a, b) for x, y in g for a in x for b in y]
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in g)
        out.append((i, sum(len(x) for x, _ in g), sum(len(y) for _, y in g), len(g), len(links), sum(count[p] == best[p[0]] for p in links),
                    sum(count[p] for p in links), hashlib.sha256(text.encode()).hexdigest() if g else ""))
    return out, count


def order(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: (r[0] is None, r))


ODD = ["", None, " ", "  ", "\n", "a", "a  b", " a b ", "a\tb\n\nc  \r\n d", "x\u00a0 y \u3000z \u2028 w", "<|endoftext|> <s> </s> <unk> <0x0A>", "under▁score", "▁", "naïve café 東京 ☃ 😀 ½ ﬁ",
       "don't we'll I'm 'tis", "12345 6,789.01", "word word word word", "aaaaaaaaaaaaaaaaaa", "});\r\n}\r\n", "\x00 a\x00b", "\x1c \x1d x", "e\u0301 z\u0308", "tail\n", "\ttab", "long" * 3000 + " end"]


def test_odd_texts_repeats_and_nulls(spark):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(None, "a word"), (None, "a word"), (7, "another text"), (7, "a  b")]
    got = align(spark.createDataFrame(rows, FIELDS).repartition(3))
    want, _ = brute(rows)
    assert order(got.collect()) == order(want)
    spelt = sorted(hashlib.sha256(r.groups.encode()).hexdigest() if r.groups else "" for r in groups_as_text(spark.createDataFrame(rows, FIELDS)).collect())
    assert spelt == sorted(r[-1] for r in want)
    plain = {r.doc_id: tuple(r)[1:] for r in got.collect()}
    assert plain[0] == plain[1] == plain[11] == plain[12] == ZERO


def test_documents_against_whole_texts(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    want, count = brute([tuple(r) for r in docs.collect()])
    assert order(op13_token_alignment(spark, "/root/testdata/sf0.001").collect()) == order(want)
    pair = loaded(None, None)
    odd = {(r.code // len(pair.b_size), r.code % len(pair.b_size)): r.n for r in pair_counts(block_rows(docs)).collect()}
    assert odd == {p: n for p, n in count.items() if pair.same[p[0]] != p[1]}


def test_small_blocks_and_a_full_memory(spark, monkeypatch):
    """A block's size and what a task remembers change nothing."""
    rows = [(i, f"Some words{i % 7} stand, here{i % 3} and the {i} return\nthere") for i in range(60)]
    pair, book = loaded(None, None), alignment.Book(loaded(None, None))
    want, _ = brute(rows)
    assert order(align(spark.createDataFrame(rows, FIELDS).repartition(5)).collect()) == order(want)
    monkeypatch.setattr(alignment, "CACHED_WORDS", 5)
    words = [w.encode() for w in "some words are known and others return".split()]
    for k in range(len(words)):
        entry = book.find(words[:k + 1])
        ids = [pair.a.encode(w.decode(), add_special_tokens=False).ids for w in words[:k + 1]]
        assert [book.numbers[e][0] for e in entry] == [len(i) for i in ids] or any(book.numbers[e][4] for e in entry)


def test_words_are_cut_before_white_space():
    coded, first = words_of(pa.array(["a b\n c", None, "x\u00a0 y z"]))
    words = [coded.dictionary[i].as_py().decode() for i in coded.indices.to_pylist()]
    assert [words[f:g] for f, g in zip(first[:-1], first[1:])] == [[" a", " b", "\n c"], [" "], [" x\u00a0 y z"]]


def test_byte_letters():
    letters = byte_letters()
    assert sorted(letters.values()) == list(range(256)) and letters["Ġ"] == 32 and letters["Ċ"] == 10


def test_empty_table_and_further_columns(spark):
    assert align(spark.createDataFrame([], FIELDS)).collect() == []
    wide = spark.createDataFrame([(1, "a b", "x", 9, 8)], FIELDS + ", block string, n long, kind int")
    assert order(align(wide).collect()) == order(brute([(1, "a b")])[0])


def test_a_piece_past_a_word_is_refused(monkeypatch):
    pair = loaded(None, None)
    class Odd:
        def __init__(self, model_file): pass
        def __getattr__(self, name): return getattr(pair.b, name)
        def id_to_piece(self, i): return "of▁the" if i == 300 else pair.b.id_to_piece(i)
    import sentencepiece
    monkeypatch.setattr(sentencepiece, "SentencePieceProcessor", Odd)
    with pytest.raises(ValueError, match="past a word"):
        alignment.Pair(*alignment.tokenizer_paths(None, None))
