import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _run(*args):
    return subprocess.run([sys.executable, "-m", "tabml", *args], cwd=ROOT, capture_output=True, text=True,
                          timeout=600)


def test_cli_lists_jobs_and_queries():
    r = _run("list")
    assert r.returncode == 0
    assert "job cars: tasks cars_reg, cars_clf, cars_clu" in r.stdout
    assert "query ols_holdout_metrics [C]" in r.stdout


def test_cli_runs_a_json_job():
    r = _run("run", os.path.join(ROOT, "examples", "orders_price.json"), "--data", "/root/testdata/sf0.001")
    assert r.returncode == 0, r.stderr[-2000:]
    assert "price_ols" in r.stdout and "status_clf" in r.stdout
