"""The pipeline's mixing stage."""

import io
import re
from contextlib import redirect_stdout

import corpus_pipeline
from flowtide.llm import mixing


def test_one_python_worker_a_task(spark, tmp_path, monkeypatch):
    """Topics and tokens are computed in one pass of one worker; two would double what an executor holds."""
    seen = []
    whole = mixing.stash
    monkeypatch.setattr(mixing, "stash", lambda df, tag: (seen.append(df), whole(df, tag))[1])
    rows = [(k, " ".join(f"w{k * j % 17}" for j in range(1, 30)), "en", "src1", 0) for k in range(40)]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert corpus_pipeline.mix(spark, d, "").count() <= 40
    said = io.StringIO()
    with redirect_stdout(said):
        seen[0].explain()
    assert len(re.findall(r"ArrowEvalPython", said.getvalue())) == 1
