"""Secret scans (operator 12).

Base rules find assignments to a secret's name, access keys and long runs of hex digits (``BASE``).  The token-efficiency test
adds what no rule names: a stretch of key characters that a vocabulary built from natural text spells with few characters a
token is a random string.  Such a vocabulary has tokens for what people write, in many languages, and none for
random letters, so words take 2 to 5 characters a token and keys 1 to 1.6.

Not tested for it: stretches of fewer than ``LEAST`` characters, those without ``PIECE`` letters or digits on end (dates,
numbers with groups, slugs), those of one kind of letter or of digits alone, and known digests and identifiers (``KNOWN``: digests by
their length or label, UUIDs, addresses of pages and files).  A stretch that meets a span of a base rule is not reported again.

Spans are ``kind, start, stop`` in code points, the stop exclusive, ordered by start and kind.  A null text counts as empty and has
no span; rows sharing a doc_id and rows without one are scanned each on their own; an empty table gives an empty one; other
columns are ignored.  Each text is read whole.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm.common import documents, text_slices, texts

#: Kinds in the order of the contract; ``random`` is the token test's.
KINDS = ("assign", "access", "hex", "random")
#: Fixed patterns of the base rules, and the least length of what each one counts.
BASE = (("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII), 2, 6),
        ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
        ("hex", re.compile(r"[0-9a-f]+"), 0, 24))
#: The same, as a test of whole texts: a text that it does not match holds none of them.
HINTS = (r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]""", r"AKIA[A-Z0-9]{16}", r"[0-9a-f]{24}")

LEAST, PIECE = 20, 12
RATIO = 1.7  # characters a token, at most; of random strings of 20 characters of letters and digits, 99.9 % are below it
STRETCH = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % LEAST)
#: Known digests and identifiers, as whole stretches.
KNOWN = re.compile(r"(?:sha(?:1|224|256|384|512)|md5)[-=][A-Za-z0-9+/]+=*"                     # labelled digests
                   r"|(?:[0-9a-fA-F]{32}|[0-9a-fA-F]{40}|[0-9a-fA-F]{56}|[0-9a-fA-F]{64}|[0-9a-fA-F]{96}|[0-9a-fA-F]{128})"  # digests by length
                   r"|[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}")                     # UUIDs
#: Addresses up to a query, and paths of files: what stands in them names something.
ADDRESS = re.compile(r"[A-Za-z][A-Za-z0-9+.-]{1,20}://[^\s?#]*|(?:(?<=\s)|^)\.{0,2}/(?:[\w.-]+/)+[\w.-]*", re.ASCII)


def default_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@lru_cache(maxsize=1)
def encoding(path: str | None):
    """The vocabulary's encoder, without special tokens."""
    import public_tokenizers
    import tiktoken
    with open(path or default_vocabulary(), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("secrets", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Matches of the base rules, leftmost and not overlapping per kind; those too short go after they matched."""
    return [(kind, m.start(), m.end()) for kind, pattern, group, least in BASE for m in pattern.finditer(text) if m.end(group) - m.start(group) >= least]


def mixed(stretch: str) -> bool:
    """Whether a stretch has digits and letters, or letters of both cases other than by words with capitals."""
    letters = re.sub("[^A-Za-z]", "", stretch)
    if re.search("[0-9]", stretch):
        return bool(letters)
    return len(re.findall("[a-z][A-Z]|[A-Z]{2}[a-z]", letters)) * 5 >= len(letters)


def random_spans(text: str, encoder, ratio: float = RATIO) -> list[tuple[str, int, int]]:
    """Stretches that the vocabulary spells with at most ``ratio`` characters a token."""
    found, named = [], None
    for m in STRETCH.finditer(text):
        stretch = m.group()
        core = stretch.strip("=-_/+")
        if max(map(len, re.split(r"[+/_=-]+", core))) < PIECE or not mixed(core) or KNOWN.fullmatch(core) or KNOWN.fullmatch(stretch):
            continue
        if len(stretch) > ratio * len(encoder.encode_ordinary(stretch)):
            continue
        if named is None:
            named = [a.span() for a in ADDRESS.finditer(text)]
        if not any(a < m.end() and m.start() < b for a, b in named):
            found.append(("random", *m.span()))
    return found


def spans(text: str, encoder, ratio: float = RATIO) -> list[tuple[str, int, int]]:
    """All spans of a text, ordered by start and kind."""
    base = sorted(base_spans(text), key=lambda s: s[1])
    more, at, reach = [], 0, -1
    for kind, a, b in random_spans(text, encoder, ratio):
        while at < len(base) and base[at][1] < b:
            reach, at = max(reach, base[at][2]), at + 1
        if reach <= a:  # no base span that begins before its end goes past its start
            more.append((kind, a, b))
    return sorted(base + more, key=lambda s: (s[1], KINDS.index(s[0])))


def scan(docs: DataFrame, vocabulary: str | None = None, ratio: float = RATIO) -> DataFrame:
    """Per document of ``docs`` (doc_id, text): doc_id and its spans (kind, start, stop)."""
    kind = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64())])
    some_hint = "|".join((*HINTS, STRETCH.pattern))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoding(vocabulary)
        for batch in batches:
            for run in text_slices(batch):
                column = texts(run.column("text"))
                hit = pc.match_substring_regex(column, some_hint)
                rows = [[dict(zip(("kind", "start", "stop"), s, strict=True)) for s in spans(t.as_py(), encoder, ratio)] if h.as_py() else []
                        for t, h in zip(column, hit, strict=True)]
                yield pa.RecordBatch.from_arrays([run.column("doc_id"), pa.array(rows, pa.list_(kind))], names=["doc_id", "spans"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(read, "doc_id long, spans array<struct<kind: string, start: long, stop: long>>")


def op12_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(documents(spark, sf_dir))
    def as_text(s: str) -> str:
        return f"array_join(transform({s}, s -> concat(s.kind, ':', s.start, ':', s.stop)), ',')"
    counts = [F.expr(f"CAST(size(filter(spans, s -> s.kind = '{k}')) AS BIGINT)").alias(f"n_{k}") for k in KINDS]
    return found.select("doc_id", *counts, F.sha2(F.expr(as_text("filter(spans, s -> s.kind != 'random')")), 256).alias("base_sha256"),
                        F.expr(as_text("spans")).alias("spans"))
