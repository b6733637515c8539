import os
import subprocess
import sys

import corpus_pipeline as p
from llm_cases import awkward, nothing

from caskline.llm.common import staged
from conftest import ROOT


def test_stages_follow_each_other(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, n = docs.columns, docs.count()
    for name, stage in p.STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"test-{name}")
        assert docs.columns == columns
        assert 0 < docs.count() <= n
        n = docs.count()
    bench = [r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    rows = docs.collect()
    assert not any(t in r.text for r in rows for t in bench)
    assert all(r.n_chars == len(r.text) for r in rows)
    seen = set()
    for r in sorted(rows, key=lambda r: r.doc_id):
        data = r.text.encode()
        own = {data[k : k + 100] for k in range(len(data) - 99)}
        # What was cut out may bring neighbours together, but nothing of the input stands twice.
        assert len(own & seen) <= 100
        seen |= own
    last = p.STAGES[-1][1](spark, docs, sf_dir)
    assert all(r.taken == r.size * r.copies and 1 <= r.copies <= 3 for r in last.collect())


def test_run_repeats_itself(spark, sf_dir):
    a, b = ({(r.doc_id, r.text, r.copies) for r in p.run(spark, sf_dir).collect()} for _ in range(2))
    assert a and a == b


def test_awkward_rows_pass_every_stage(spark, sf_dir):
    for docs in (awkward(spark), nothing(spark)):
        for name, stage in p.STAGES:
            out = staged(stage(spark, docs, sf_dir), f"test-{name}")
            assert out.count() <= docs.count()
            assert set(docs.columns) <= set(out.columns)


def test_the_rest_works_without_this_part(tmp_path):
    for name in ("caskline", "registry", "__spark_entry__.py"):
        os.symlink(f"{ROOT}/{name}", tmp_path / name) if name != "caskline" else None
    (tmp_path / "caskline").mkdir()
    for name in os.listdir(f"{ROOT}/caskline"):
        if name != "llm":
            os.symlink(f"{ROOT}/caskline/{name}", tmp_path / "caskline" / name)
    code = (tmp_path / "__spark_entry__.py").read_text()
    (tmp_path / "__spark_entry__.py").unlink()
    (tmp_path / "__spark_entry__.py").write_text(code)
    said = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(*e.queries())"], cwd=tmp_path, capture_output=True, text=True, env={**os.environ, "PYTHONPATH": ""})
    assert "kpi_card" in said.stdout and "op1_" not in said.stdout and "pipeline" not in said.stdout
