"""Every registered query with an oracle against its DuckDB statement; columns and row counts of the others."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "tools"))

from check_oracle import duck, rows_of  # noqa: E402

from opsmetrics.llm import registry  # noqa: E402

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
KINDS = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
COLUMNS = {
    "op1_html_text": "page_id bigint, url string, text string, n_chars bigint",
    "op3_nearest": "query_id bigint, rank int, vec_id bigint, score double",
    "op4_token_counts": "n_tokens bigint, n_docs bigint, docs_at_least bigint, tokens_at_least bigint, total_docs bigint, total_tokens bigint, truncated_total bigint, share_within double",
    "op6_language_id": "doc_id bigint, held_out boolean, lang_pred string, score double",
    "op7_language_model": "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double",
    "op9_simhash": "doc_id bigint, fingerprint string, component_id bigint",
    "op10_toxicity": "doc_id bigint, held_out boolean, score double, predicted int",
    "op13_suffix_dedup": "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string",
}


@pytest.mark.parametrize("key", sorted(registry.oracle_sql()))
def test_query_matches_oracle(spark, key):
    df = registry.queries()[key](spark, SF)
    rel = duck(SF).sql(registry.oracle_sql()[key])
    assert sorted(df.columns) == sorted(rel.columns)
    types = dict(zip(rel.columns, map(str, rel.types)))
    assert {n: KINDS.get(t, t) for n, t in df.dtypes} == types
    assert rows_of(df.collect(), df.columns) == rows_of(rel.fetchall(), rel.columns)


@pytest.mark.parametrize("key", sorted(set(registry.queries()) - set(registry.oracle_sql())))
def test_query_columns_and_rows(spark, key):
    df = registry.queries()[key](spark, SF)
    assert ", ".join(f"{n} {t}" for n, t in df.dtypes) == COLUMNS[key]
    n = df.count()
    table = {"op1_html_text": "pages", "op3_nearest": None, "op4_token_counts": None}.get(key, "documents")
    assert n == spark.read.parquet(f"{SF}/{table}.parquet").count() if table else n > 0


def test_workers_find_the_package_wherever_spark_is_started(tmp_path):
    """In a process of its own, outside the repository and without its path in the environment."""
    import subprocess

    repo = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    code = f"""
import sys
sys.path.insert(0, {repo!r})
from opsmetrics.session import build_session
import __spark_entry__ as se
spark = build_session("local[2]", 2, extra={{"spark.checkpoint.dir": {str(tmp_path / "ckpt")!r}}})
print("rows", se.queries()["op6_language_id"](spark, {SF!r}).count(), se.queries()["op5_url_filter"](spark, {SF!r}).count())
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "rows 200" in done.stdout, done.stderr[-2000:]
