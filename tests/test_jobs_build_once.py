"""What a job reads again and again is built once."""

from fieldline.plans import jobs, q_jobs, views


def test_seasons_read_games_that_were_built_once(spark, tables, monkeypatch):
    built, plans = [], []
    view, season = views.game_log_view, jobs.season_games

    def counted(*a):
        built.append(1)
        return view(*a)

    def planned(games, odds_log, *a):
        plans.append(games.unionByName(games)._jdf.queryExecution().optimizedPlan().toString() + odds_log._jdf.queryExecution().optimizedPlan().toString())
        return season(games, odds_log, *a)

    monkeypatch.setattr(views, "game_log_view", counted)
    monkeypatch.setattr(q_jobs, "game_log_view", counted)
    monkeypatch.setattr(jobs, "season_games", planned)
    summary = {r.season: r.n_rows for r in q_jobs.q_run_summary(spark, tables).collect()}
    assert len(built) == 1 and plans and not any("l_orderkey" in p for p in plans)
    assert set(summary) == {1999}


def test_tails_read_stored_games(spark, tables, monkeypatch):
    plans, start = [], jobs.start_tails

    def planned(session, games, *a):
        plans.append(games._jdf.queryExecution().optimizedPlan().toString())
        return start(session, games, *a)

    monkeypatch.setattr(jobs, "start_tails", planned)
    assert q_jobs.q_rolled_day_features(spark, tables).count() == 4
    assert len(plans) == 1 and "l_orderkey" not in plans[0]


def test_results_are_parsed_once(spark, tables, monkeypatch):
    plans, store = [], jobs.game_results

    def planned(session, results, *a):
        plans.append(results._jdf.queryExecution().optimizedPlan().toString())
        return store(session, results, *a)

    monkeypatch.setattr(jobs, "game_results", planned)
    assert q_jobs.q_landed_results(spark, tables).count() == 200
    assert len(plans) == 2 and not any("from_json" in p or "jsontostructs" in p for p in plans)
