import hashlib
import random
import re
import string
import uuid

from skyledger.llm.secrets import RATIO, base_spans, encoding, mixed, op12_secret_scans, scan, spans

FIELDS = "doc_id long, text string"
NAMES = ["password", "passwd", "secret", "token", "api_key", "apikey"]
VALUE = set(string.ascii_letters + string.digits + "+/_.=-")


def base_by_hand(text):
    """The base rules, character by character."""
    out, low = [], "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    i = 0
    while i < len(text):
        found = None
        for name in NAMES:
            if not low.startswith(name, i):
                continue
            for quote in (1, 0):  # an optional quote is tried first
                j = i + len(name)
                if quote and text[j:j + 1] in ('"', "'") and text[j:j + 1]:
                    j += 1
                elif quote:
                    continue
                while text[j:j + 1] == " ":
                    j += 1
                if text[j:j + 1] not in (":", "="):
                    continue
                j += 1
                while text[j:j + 1] == " ":
                    j += 1
                if text[j:j + 1] and text[j] in "\"'":
                    j += 1
                k = j
                while k < len(text) and text[k] in VALUE:
                    k += 1
                if k > j:
                    found = (j, k)
                    break
            if found:
                break
        if found:
            if found[1] - found[0] >= 6:
                out.append(("assign", i, found[1]))
            i = found[1]
        else:
            i += 1
    i = 0
    while (i := text.find("AKIA", i)) >= 0:
        k = i + 4
        while k < len(text) and text[k] in string.ascii_uppercase + string.digits:
            k += 1
        if k - i >= 20:
            out.append(("access", i, k))
        i = k if k > i + 4 else i + 1
    i = 0
    while i < len(text):
        k = i
        while k < len(text) and text[k] in "0123456789abcdef":
            k += 1
        if k - i >= 24:
            out.append(("hex", i, k))
        i = max(k, i + 1)
    return sorted(out, key=lambda s: (s[1], ["assign", "access", "hex"].index(s[0])))


def random_by_hand(text, encoder):
    """The token test over words cut at every character that is no key character."""
    out = []
    for m in re.finditer(r"[^A-Za-z0-9+/_=-]+|$", text):
        start = max([0] + [e.end() for e in re.finditer(r"[^A-Za-z0-9+/_=-]+", text) if e.end() <= m.start()])
        word = text[start:m.start()]
        if len(word) >= 20 and len(word) <= RATIO * len(encoder.encode_ordinary(word)):
            out.append((start, m.start()))
    return out


def key(rng, n, letters=string.ascii_letters + string.digits):
    return "".join(rng.choice(letters) for _ in range(n))


PARTS = ["password", "Token", "API_KEY", "apikey", "secret", "passwd", "'", '"', " ", "  ", ":", "=", "==", "abc", "abcdef", "x9/+_.-=", "AKIA", "AKIAAKIA", "é", "ſecret", "toKen", "\n",
         "0123456789abcdef", "deadbeef", "ABCDEFGHIJKLMNOP", ".", "word", "token:token:token", "☃"]


def test_base_rules_against_a_scan_by_hand():
    rng = random.Random(3)
    for _ in range(6000):
        text = "".join(rng.choice(PARTS) for _ in range(rng.randrange(14)))
        got = sorted(base_spans(text), key=lambda s: (s[1], ["assign", "access", "hex"].index(s[0])))
        assert got == base_by_hand(text), text


def test_random_strings_are_found_and_words_are_not():
    rng, encoder = random.Random(4), encoding(None)
    found = 0
    for _ in range(500):
        secret = key(rng, rng.choice((20, 24, 32, 40)))
        text = f"naïve words before {secret} and after it"
        got = [s for s in spans(text, encoder) if s[0] == "random"]
        found += got == [("random", 19, 19 + len(secret))]
        if not any(s[0] != "random" for s in spans(text, encoder)) and mixed(secret):
            assert {s[1:] for s in got} == set(random_by_hand(text, encoder))
    assert found >= 490
    for text in ["getElementsByClassName internationalization Donaudampfschifffahrtsgesellschaft", "this_is_a_snake_case_name/and/another_one", f"id {uuid.UUID(int=7 ** 40)}",
                 "2024-01-01T00:00:00-2025-02-02", "1234567890123456 4111 1111 1111 1111 12345678901234567890", "Anticonstitutionnellementparlementairement", "HTTPSConnectionPoolManager",
                 hashlib.sha1(b"a").hexdigest().upper(), hashlib.sha256(b"b").hexdigest().upper(), "sha256-" + key(rng, 43) + "=", "https://host.example/" + key(rng, 30), "/usr/lib/" + key(rng, 24) + "/x",
                 "----------------------------------------", "=" * 50, "a" * 60, "AAAAAAAAAAAAAAAAAAAAAAAAAAAA"]:
        assert [s for s in spans(text, encoder) if s[0] == "random"] == [], text


def test_spans_of_base_rules_stay_and_are_not_repeated():
    rng, encoder = random.Random(5), encoding(None)
    secret, hexed = key(rng, 30), "0f" * 12
    text = f"password = '{secret}' {hexed} AKIA{'7Q' * 8} {secret}"
    at = text.rindex(secret)
    assert spans(text, encoder) == [("assign", 0, 12 + 30), ("hex", 44, 68), ("access", 69, 89), ("random", at, at + 30)]


def test_documents_nulls_repeats_and_further_columns(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = {r.doc_id: r for r in op12_secret_scans(spark, "/root/testdata/sf0.01").collect()}
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    assert rows.keys() == texts.keys()
    for i, text in texts.items():
        base, r = base_by_hand(text), rows[i]
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(s[0] == k for s in base) for k in ("assign", "access", "hex"))
        assert [s for s in r.spans.split(",") if s and not s.startswith("random")] == joined.split(",") * bool(joined)
    odd = [(1, None, "a", 1), (2, "", "b", 2), (None, "token: abcdefg", "c", 3), (None, "token: abcdefg", "c", 3), (3, "☃" * 100_000 + "secret=abcdef", "d", 4), (3, "x", None, None)]
    got = sorted(((r.doc_id, [tuple(s) for s in r.spans]) for r in scan(spark.createDataFrame(odd, FIELDS + ", kind string, spans long")).collect()), key=str)
    assert got == sorted([(1, []), (2, []), (None, [("assign", 0, 14)]), (None, [("assign", 0, 14)]), (3, [("assign", 100_000, 100_013)]), (3, [])], key=str)
    assert scan(spark.createDataFrame([], FIELDS)).collect() == []
