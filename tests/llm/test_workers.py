"""Operators with Python code run on workers that have no copy of the package."""

import os
import subprocess
import sys
import tempfile
import textwrap

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SCRIPT = textwrap.dedent(
    """
    import sys
    sys.path.insert(0, {repo!r})
    from pyspark.sql import SparkSession
    from clickmart.llm.queries import QUERIES

    spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(40).write.parquet("data/documents.parquet")
    for name in ("labels", "embeddings"):
        spark.read.parquet(f"/root/testdata/sf0.001/{{name}}.parquet").write.parquet(f"data/{{name}}.parquet")
    for name in ("op2_packing", "op3_maxent_lm", "op4_permutation_index", "op6_toxicity", "op7_token_files", "op8_parity_join", "op11_exact_topk", "op12_divergence", "op13_hard_negatives"):
        print(name, QUERIES[name](spark, "data").count(), flush=True)
    print("WORKERS-OK")
    """
)


def test_workers_run_without_installed_package():
    cwd = tempfile.mkdtemp(prefix="clickmart-cwd-")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    r = subprocess.run([sys.executable, "-c", SCRIPT.format(repo=REPO)], cwd=cwd, env=env, capture_output=True, text=True, timeout=900)
    assert "WORKERS-OK" in r.stdout, r.stdout[-500:] + r.stderr[-3000:]


def test_a_worker_keeps_the_words_of_one_helper_at_a_time():
    """The words of one step go when the next step's helper starts; within a step they stay."""
    from clickmart.llm import maxent_lm, parity_join, tokens

    parity_join.word_hashes(["one two"])
    held = tokens.worker_kept("word_hashes", dict)
    assert held and tokens.worker_kept("word_hashes", dict) is held
    enc = tokens.encoder(tokens.tokenizer_path("byte_bpe_50k.json"))
    assert tokens.encoder(tokens.tokenizer_path("byte_bpe_50k.json")) is enc
    assert tokens.worker_store().kept == ("encoders", {tokens.tokenizer_path("byte_bpe_50k.json"): enc})
    assert not hasattr(enc, "bare")  # and no second tokenizer that it never asks
    assert maxent_lm.lexicon() is maxent_lm.lexicon()


def test_what_a_worker_keeps_is_bounded_and_what_comes_again_stays():
    from clickmart.llm.tokens import Recent

    known = Recent(100)
    for i in range(1000):
        words = ["often", f"w{i}"]
        found = known.find(words)
        assert found == ([None, None] if i == 0 else [7, None])
        known.add([w for w, v in zip(words, found) if v is None], [7 for v in found if v is None])
        assert len(known) <= 202
    assert known.find(["w999", "w950", "w1"]) == [7, 7, None]


def test_pipeline_steps_hold_few_words_and_toxicity_takes_texts_in_runs(monkeypatch):
    """Scoring holds neither all texts of a batch as strings nor every word it has met."""
    import numpy as np
    import pyarrow as pa

    from clickmart.llm import tokens, toxicity

    class Docs:
        columns = ["doc_id"]
        schema = type("S", (), {"add": lambda self, *a: self})()

        def drop(self, _):
            return self

        def select(self, *_):
            return self

        def mapInArrow(self, run, _):
            return run

    seen, runs = [], []
    monkeypatch.setattr(toxicity, "CACHE_WORDS", 500)
    monkeypatch.setattr(toxicity, "text_of", lambda: type("C", (), {"alias": lambda self, _: None})())
    monkeypatch.setattr(toxicity, "words_of", lambda text: seen.append(text) or text.split())
    monkeypatch.setattr(toxicity, "chunks", lambda texts, most: (runs.append(len(c)) or c for c in tokens.chunks(texts, 1_000)))
    run = toxicity.score(Docs(), toxicity.Model(np.arange(toxicity.BUCKETS, dtype=np.float32), 0.0))
    texts = [f"the word{i} other{i}" for i in range(3_000)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["doc_id", "text"])
    (out,) = run(iter([batch]))
    assert len(seen) == out.num_rows == sum(runs) == len(texts) and max(runs) < 100
    (kept,) = tokens.worker_store().kept[1].values()
    assert len(kept) <= 500 and "the" in kept
    other = toxicity.score(Docs(), toxicity.Model(np.ones(toxicity.BUCKETS, dtype=np.float32), 0.0))
    list(other(iter([batch.slice(0, 5)])))  # another model's words go
    (kept,) = tokens.worker_store().kept[1].values()
    assert len(kept) == 11


def test_known_words_are_columns_and_those_that_come_again_stay():
    import numpy as np
    import pyarrow as pa

    from clickmart.llm.tokens import Known

    known = Known(100)
    for i in range(1000):
        words = pa.array(["often", f"w{i}"], pa.large_string())
        at = known.find(words)
        assert (at < 0).tolist() == [i == 0, True]
        new = np.flatnonzero(at < 0)
        known.add(words.take(pa.array(new)), np.repeat(np.array([7, i], "<u4")[new], 2), np.full(len(new), 2))
        assert len(known) <= 202
    at = known.find(pa.array(["w999", "w950", "w1", "often"], pa.large_string()))
    ids = known.ids.reshape(-1, 2)
    assert at[2] < 0 and [ids[i].tolist() for i in at[[0, 1, 3]]] == [[999, 999], [950, 950], [7, 7]]


def test_a_worker_without_a_task_holds_no_words_and_ids_come_in_runs(monkeypatch):
    """Batches are not gathered, and what a task has learned goes when it ends."""
    import pyarrow as pa

    from clickmart.llm import packing, parity_join, tokens

    class Docs:
        schema = {"doc_id": type("F", (), {"dataType": type("T", (), {"simpleString": staticmethod(lambda: "bigint")})})}

        def select(self, *_):
            return self

        def mapInArrow(self, run, _):
            return run

    for module in (packing, parity_join):
        monkeypatch.setattr(module, "text_of", lambda: type("C", (), {"alias": lambda self, _: None})())
    monkeypatch.setattr(packing.TaskContext, "get", lambda: type("C", (), {"partitionId": lambda self: 3})())
    monkeypatch.setattr(parity_join.F, "col", lambda _: type("C", (), {"cast": lambda self, _: self, "alias": lambda self, _: self})())
    texts = [f"the word{i} other{i} " + "x" * 10_000 for i in range(1_000)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["doc_id", "text"])
    name = tokens.tokenizer_path("byte_bpe_50k.json")
    got = list(packing.tokenise(Docs(), name)(iter([batch, batch.slice(0, 0)])))
    assert len(got) > 4 and [i for b in got for i in b.column("row").to_pylist()] == list(range(1_000))
    assert got[0].column("ids")[0].as_py() == tokens.encoder(name).encode(texts[0]) + bytes(4)
    tokens.encoder(name).forget()
    list(packing.tokenise(Docs(), name)(iter([batch])))
    assert len(tokens.encoder(name).words) == 0
    list(parity_join.shingled(Docs(), 4, 85)(iter([batch])))
    assert not tokens.worker_kept("word_hashes", dict)


def test_other_white_space_is_what_python_calls_it():
    import pyarrow as pa
    import pyarrow.compute as pc

    from clickmart.llm import tokens

    signs = [chr(i) for i in range(0x11000) if not 0xD800 <= i < 0xE000]
    found = pc.match_substring_regex(pa.array(signs), tokens._OTHER_SPACE).to_pylist()
    assert found == [s.isspace() and s not in " \n" for s in signs]
