import threading

from strataflow.operators import search as N
from strataflow.plans import q_fitted


def test_random_search_runs_all_trials_of_the_original(spark, monkeypatch):
    monkeypatch.setattr(q_fitted, "latent_table", lambda spark, sf_dir: None)
    monkeypatch.setattr(q_fitted, "_lr_objective", lambda spark, lat: lambda params: {"fitness": params["threshold"]})
    rows = q_fitted.q_random_search(spark, "none").orderBy("trial").collect()
    assert [r["trial"] for r in rows] == list(range(30)) and len({r["param_reg_param"] for r in rows}) == 30
    assert all(r["fitness"] == r["param_threshold"] for r in rows)


def test_trials_do_not_depend_on_the_workers():
    space, threads = {"x": ("uniform", 0, 1)}, set()

    def objective(params):
        threads.add(threading.get_ident())
        return {"fitness": -params["x"]}

    assert N.random_search(space, objective, 9, workers=4) == N.random_search(space, objective, 9)
    assert threads and threading.get_ident() not in threads
