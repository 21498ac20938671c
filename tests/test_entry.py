import importlib
import sys

import __spark_entry__ as entry


def test_queries_have_sql():
    from intake_spark.plans import queries

    assert set(queries.SQL) == set(queries.QUERIES)
    assert set(entry.oracle_sql()) <= set(entry.queries()) and len(queries.QUERIES) > 95


def test_entry(spark):
    assert entry.entry(spark).count() >= 0


def test_without_llm(monkeypatch):
    class Gone:
        def find_spec(self, name, path=None, target=None):
            if name.startswith("intake_spark.llm") or name == "corpus_pipeline":
                raise ImportError(name)

    for name in [m for m in sys.modules if m.startswith("intake_spark.llm") or m == "corpus_pipeline"]:
        monkeypatch.delitem(sys.modules, name)
    if "intake_spark" in sys.modules and hasattr(sys.modules["intake_spark"], "llm"):
        monkeypatch.delattr(sys.modules["intake_spark"], "llm")
    monkeypatch.setattr(sys, "meta_path", [Gone(), *sys.meta_path])
    importlib.invalidate_caches()
    assert not any(q.startswith("op") and q[2].isdigit() for q in entry.queries()) and "pipeline" not in entry.queries() and "select_candidates" in entry.queries()


def test_streams_replay_nothing(spark):
    from intake_spark.plans import queries

    got = queries.QUERIES["stream_intake"](spark, "/root/testdata/sf0.001").collect()
    domains = [r.domain for r in got if r.domain]
    assert len(domains) == len({(r.batch, r.domain) for r in got if r.domain}) and {r.epoch for r in got} == {0, 1}
    first = {r.domain for r in got if r.epoch == 0 and r.domain}
    assert not first & {r.domain for r in got if r.epoch == 1}
