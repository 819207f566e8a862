from collections import Counter, defaultdict

import corpus_pipeline
from skyledger.llm import mixing, quality
from skyledger.llm.exact_dedup import exact_duplicates
from skyledger.llm.near_dedup import near_duplicates
from skyledger.llm.registry import oracle_sql, queries
from skyledger.llm.sentencepiece_scan import SPACE, vocabulary
from test_near_dedup import brute as components

SF = "/root/testdata/sf0.001"


def test_registry():
    names = list(queries())
    assert [n.split("_")[0] for n in names] == [f"op{i}" for i in range(1, len(names))] + ["pipeline"]
    assert set(oracle_sql()) <= set(names)


def check_copies(rows, copies):
    """The stage's rule: full passes count whole, parts become one copy or none, and each shard ends within half a document of its words."""
    shards = defaultdict(list)
    for r in rows:
        n = copies.pop(r.doc_id, 0)
        if r.size == 0:
            assert n == 0
            continue
        whole, part = divmod(r.taken, r.size)
        assert whole <= n <= whole + (part > 0)
        shards[r.key, r.shard].append((r.size, part, n * r.size - r.taken))
    assert not copies and shards
    for some in shards.values():
        halves = max((size for size, part, _ in some if part), default=0) / 2
        assert abs(sum(off for _, _, off in some)) <= halves


def test_stages_in_order(spark):
    """Each stage against its operator's verdicts, and the near stage against all pairs."""
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "exact_dedup", "minhash_near_dedup", "mixing", "sentencepiece"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = corpus_pipeline.staged(stage(spark, docs, SF), "test-stage")
        ids = sorted(r.doc_id for r in out.select("doc_id").collect())
        if name != "sentencepiece":
            assert out.columns == docs.columns
        if name == "quality_rules":
            want = sorted(r.doc_id for r in quality.judge(docs.select("doc_id", "lang", "text"), ["doc_id"]).where("kept").collect())
            assert ids == want and 0 < len(ids) < docs.count()
        elif name == "exact_dedup":
            assert ids == sorted(r.doc_id for r in exact_duplicates(docs.select("doc_id", "text")).where("kept").collect())
        elif name == "minhash_near_dedup":
            want = components([(r.doc_id, r.text) for r in docs.collect()], 5)
            assert ids == sorted(i for i, (_, c) in want.items() if c == i)
            assert near_duplicates(docs.select("doc_id", "text"), 5).count() == docs.count()
        elif name == "mixing":
            check_copies(mixing.dealt(docs).collect(), Counter(ids))
        else:
            v, texts = vocabulary(None), {r.doc_id: r.text for r in docs.collect()}
            assert ids == sorted(r.doc_id for r in docs.select("doc_id").collect())
            assert all(v.decode(r.ids) == texts[r.doc_id].replace(SPACE, " ") and r.n_tokens == len(r.ids) for r in out.collect())
        docs = out


def test_run_over_an_empty_and_an_odd_table(spark, tmp_path):
    fields = "doc_id long, text string, lang string, source string, n_chars long, kept string, size int, key string"
    good = " ".join(f"the cat{i} of dog{i} is in a house{i % 9}" for i in range(12))
    rows = [(1, good, "en", "a", 3, "k", 1, "x"), (2, good, None, None, None, None, None, None), (None, good + " more", "en", "a", 1, "k", 1, "x"), (3, None, None, None, 0, "k", 1, "x"),
            (4, "", "en", "b", 0, "k", 1, "x"), (5, good + " more", "en", "b", 9, "k", 1, "x")]
    for name, some in (("odd", rows), ("none", [])):
        spark.createDataFrame(some, fields).write.parquet(str(tmp_path / name / "documents.parquet"))
        out = corpus_pipeline.run(spark, str(tmp_path / name)).collect()
        assert (len(out) > 0) == bool(some)
        assert all(r.n_tokens == len(r.ids) for r in out)
