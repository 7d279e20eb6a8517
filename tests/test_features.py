import datetime as dt
from dataclasses import replace

import pytest

from fundsift.config import DEFAULT_PROFILES, CreditRating, Guardrail, Profile, Settings
from fundsift.operators import features, guardrails, holdings, normalize, scoring

from .conftest import rows

S = Settings()
RETURNS = "cnpj long, date date, daily_return double"
FIXED = [0.01, -0.0049504950495, 0.0149253731343]


@pytest.fixture
def returns(spark, day):
    return spark.createDataFrame(
        [(1, day(i), r) for i, r in enumerate(FIXED)]
        + [(2, day(0), 0.5)]
        + [(1, day(40), 9.0)],
        RETURNS,
    )


def test_volatility_and_sharpe(returns):
    vol = features.volatility(returns, 202401, S)
    got = rows(vol)
    assert got[0][:2] == (1, dt.date(2024, 1, 31))
    assert got[0][2:] == (pytest.approx(0.1643128815),) * 3
    assert got[1][2:] == (None, None, None)
    for given in (None, vol):
        first, second = rows(features.sharpe_ratio(returns, 202401, S, given))
        assert first[1:3] == (pytest.approx(9.4294240652),) * 2
        assert first[3:] == (pytest.approx(3 / 252), pytest.approx(3 / 63))
        assert second[1:] == (None, None, pytest.approx(1 / 252), pytest.approx(1 / 63))


def test_sharpe_is_capped_and_needs_volatility(spark, day):
    steady = [(1, day(i), 0.01 + (i % 2) * 1e-5) for i in range(10)]
    flat = [(2, day(i), 0.01) for i in range(10)]
    df = spark.createDataFrame(steady + flat, RETURNS)
    assert rows(features.sharpe_ratio(df, 202401, S), "cnpj", "sharpe_12m") == [(1, 20.0), (2, None)]


def test_windows_take_the_last_rows(spark, day):
    df = spark.createDataFrame([(1, day(i), float(i)) for i in range(20)], RETURNS)
    short = replace(S, trading_days_12m=5, trading_days_3m=2)
    vol = rows(features.volatility(df, 202401, short))[0]
    assert vol[3] == pytest.approx(2.5**0.5 * 5**0.5)
    assert vol[4] == pytest.approx(0.5**0.5 * 5**0.5)
    last = features.last_n_days(df, 3)
    assert rows(last, "daily_return") == [(17.0,), (18.0,), (19.0,)]


def test_return_evidence_matches_its_parts(returns):
    got = rows(
        features.return_evidence(returns, 202401, "2024-02-10", S),
        "cnpj", "sharpe_12m", "pct_cov_3m", "has_latest_data", "max_abs_return",
    )
    assert got == [
        (1, pytest.approx(9.4294240652), pytest.approx(3 / 63), True, 9.0),
        (2, None, pytest.approx(1 / 63), False, 0.5),
    ]


def test_liquidity(spark):
    df = spark.createDataFrame(
        [(1, 0.0, 1), (2, 30.0, 1), (3, 90.0, 1), (4, 500.0, 0), (5, 1.0, None)],
        "cnpj long, redemption_days double, is_active int",
    )
    got = rows(features.liquidity(df), "cnpj", "liquidity_score")
    assert got == [(1, 1.0), (2, pytest.approx(2 / 3)), (3, 0.0), (4, 0.0), (5, 0.0)]
    same = df.filter("cnpj = 1 or cnpj = 4")
    assert rows(features.liquidity(same), "cnpj", "liquidity_score") == [(1, 1.0), (4, 0.0)]


HOLD = "cnpj long, blc_type string, period int, TP_ATIVO string, VL_MERC_POS_FINAL double, " \
    "CNPJ_EMISSOR string, AG_RISCO string, GRAU_RISCO string"


@pytest.fixture
def positions(spark):
    def row(cnpj, value, kind="A", rating=None, family="blc_5", period=202401):
        return (cnpj, family, period, kind, value, "00.000.000/0001-00", "ag", rating)

    return spark.createDataFrame(
        [
            row(1, 60.0),
            row(1, -30.0),
            row(1, 10.0, "B"),
            row(2, None),
            row(2, None),
            row(3, 0.0),
            row(4, 5.0, None, "AAA+"),
            row(4, 5.0, "A", "BRBBB-"),
            row(4, 5.0, "A", "Ba1"),
            row(4, 5.0, "A", "F"),
            row(4, 5.0, "A", "AAA+", "blc_4"),
            row(4, 5.0, "A", "AAA+", "blc_5", 202312),
            row(1, 77.0, "B", None, "blc_1", 202312),
        ],
        HOLD,
    )


def test_portfolio(positions):
    instruments = holdings.instrument_registry(positions)
    prices = holdings.instrument_prices(instruments, 202401)
    ratings = holdings.instrument_rating(instruments)
    hhi = {r[0]: r[1:] for r in rows(features.concentration(prices))}
    assert hhi[1] == (pytest.approx(0.46), 3)
    assert hhi[2] == (0.0, 2)
    assert hhi[3] == (None, 1)
    div = {r[0]: r[1:] for r in rows(features.asset_diversification(prices))}
    assert div[1] == (pytest.approx(0.82), pytest.approx(0.9))
    assert set(div) == {1, 4}
    credit = rows(features.credit_quality(ratings, prices, CreditRating()))
    assert credit == [
        (
            4,
            1.0,
            pytest.approx(0.4696969697),
            pytest.approx(0.6666666667),
            pytest.approx(0.5878787879),
        )
    ]
    assert {r[0] for r in rows(ratings, "issuer_cnpj")} == {"00000000000100"}

    together = {r.cnpj: r for r in features.portfolio_features(positions, 202401, CreditRating()).collect()}
    assert set(together) == set(hhi)
    for cnpj, row in together.items():
        assert (row.concentration_hhi, row.concentration_num_holdings) == pytest.approx(hhi[cnpj])
        assert (row.asset_diversification_hhi, row.top_category_pct) == pytest.approx(
            div.get(cnpj, (None, None))
        )
    assert together[4].credit_quality_score == pytest.approx(credit[0][4])
    assert together[1].credit_quality_score is None


def test_instrument_ids(spark, positions):
    copies = positions.unionAll(positions).unionAll(positions)
    for per_task in (2, 100):
        ids = [r[0] for r in holdings.instrument_registry(copies, per_task).select("instrument_id").collect()]
        assert len(set(ids)) == len(ids) == 39
    again = [r[0] for r in holdings.instrument_registry(copies.repartition(7)).select("instrument_id").collect()]
    assert sorted(ids) == sorted(again)


def test_stored_instrument_ids(spark, positions, tmp_path):
    path = str(tmp_path / "holdings")
    positions.unionAll(positions).repartition(3).write.parquet(path)
    stored = holdings.stored_instrument_registry(spark.read.parquet(path))
    ids = [r[0] for r in stored.select("instrument_id").collect()]
    assert len(set(ids)) == 26
    assert "Exchange" not in stored._jdf.queryExecution().executedPlan().toString()


def test_fund_age(spark):
    df = spark.createDataFrame([(1, "2010-09-30"), (2, None), (3, "1900-01-01"), (4, "2030-01-01")], "cnpj long, inception_date string")
    got = rows(features.fund_age(df, 30.0, "2025-09-30"), "cnpj", "fund_age_days", "fund_age_years", "fund_age_score")
    assert got[0] == (1, 5479, pytest.approx(15.0109589041), pytest.approx(0.5003652968))
    assert got[1] == (2, None, None, None)
    assert (got[2][3], got[3][3]) == (1.0, 0.0)


def test_merge_features(spark):
    base = spark.createDataFrame([(1, 1), (2, 1), (3, 0)], "cnpj long, is_active int")
    a = spark.createDataFrame([(1, 1, float("nan")), (3, 0, 1.0)], "cnpj long, is_active int, x double")
    b = spark.createDataFrame([(2, 5.0)], "cnpj long, y double")
    assert rows(features.merge_features(base, a, b)) == [(1, 1, None, None), (2, 1, None, 5.0)]


FEATURES = "cnpj long, volatility double, sharpe_12m double, sharpe_3m double, liquidity_score double, " \
    "concentration_hhi double, asset_diversification_hhi double, fund_age_score double, " \
    "credit_quality_score double"


def test_scoring_input(spark):
    data = [
        (i, i / 10, None if i == 1 else float(i), 4.0, float(i), float(i), 7.0, float(i), None if i % 2 else float(i))
        for i in range(1, 22)
    ]
    got = {r.cnpj: r for r in normalize.scoring_input(spark.createDataFrame(data, FEATURES), S).collect()}
    assert [got[i].liquidity_score for i in (1, 2, 11, 20, 21)] == [0.0, 0.0, 0.5, 1.0, 1.0]
    assert [got[i].concentration_score for i in (1, 2, 11, 20, 21)] == [1.0, 1.0, 0.5, 0.0, 0.0]
    assert got[1].credit_quality_score is None and got[4].credit_quality_score is not None
    assert got[1].sharpe_score == pytest.approx((4.0 - 3.0) / (20.0 - 3.0))
    assert got[5].asset_diversification_score is None  # no range
    assert got[2].volatility_score == 1.0 and got[21].volatility_score == 0.0


def test_equal_sharpe_ratios_score_one(spark):
    data = [(i, 0.1 * i, 2.0 if i else None, None, 1.0, 1.0, 1.0, 1.0, 1.0) for i in range(3)]
    got = normalize.scoring_input(spark.createDataFrame(data, FEATURES), S)
    assert rows(got, "cnpj", "sharpe_score") == [(0, None), (1, 1.0), (2, 1.0)]


SCORES = "cnpj long, volatility_score double, sharpe_score double, liquidity_score double, " \
    "concentration_score double, asset_diversification_score double, fund_age_score double, " \
    "credit_quality_score double"


def test_profile_scores(spark):
    df = spark.createDataFrame(
        [(1, 0.8, 0.5, 1.0, 0.2, 0.4, 0.6, None), (2,) + (None,) * 7, (3, float("nan"), 0.1, *([None] * 5))],
        SCORES,
    )
    got = scoring.scores_per_profile(df, S).filter("investor_profile = 'speculator'")
    by_fund = {r.cnpj: r for r in got.collect()}
    assert by_fund[1].score == pytest.approx(0.5472360249)
    assert by_fund[1].pct_features_considered == pytest.approx(85.7142857143)
    assert by_fund[2].score == 0.0 and by_fund[2].pct_features_considered == 0
    assert by_fund[3].pct_features_considered == pytest.approx(100 / 7)
    assert [by_fund[i].rank for i in (1, 3, 2)] == [1, 2, 3]


def test_features_without_weight_give_no_score(spark):
    only = Profile("only", 1.0, 0.0, 0.0, 0.0, 0.0, 0.0)
    df = spark.createDataFrame([(1, 0.5, *([None] * 6)), (2, None, None, 0.5, *([None] * 4))], SCORES)
    got = scoring.scores_per_profile(df, replace(S, profiles=(only,)))
    assert rows(got, "cnpj", "rank") == [(1, None), (2, 1)]


def test_weights_must_sum_to_one():
    with pytest.raises(ValueError, match="sum to"):
        Profile("bad", 0.5, 0.1, 0.1, 0.1, 0.1, 0.0)


def test_rankings(spark):
    scored = spark.createDataFrame(
        [(i, p.name, None if i == 4 else i / 10, 100.0) for i in range(1, 9) for p in DEFAULT_PROFILES],
        "cnpj long, investor_profile string, score double, pct_features_considered double",
    )
    marks = spark.createDataFrame([(i, i != 8, None) for i in range(1, 9)], "cnpj long, pass_guardrail boolean, failed_guardrails string")
    chars = spark.createDataFrame(
        [(i, "Profissional" if i < 4 else "Geral", "Renda Fixa Simples" if i == 7 else "x", "m", f"fund {i}") for i in range(1, 9)],
        "cnpj long, target_investor_type string, fund_subtype string, fund_manager string, commercial_name string",
    )
    wanted = scoring.eligible(scored, marks, chars, S)
    full = rows(scoring.complete_ranking(wanted), "Investor Profile", "Rank", "CNPJ", "Score")
    assert full[:2] == [("aggressive", 1, "00.000.000/0000-07", 0.7), ("aggressive", 2, "00.000.000/0000-06", 0.6)]
    counts = {p: sum(r[0] == p for r in full) for p in ("aggressive", "moderate", "conservative", "speculator")}
    assert counts == {"aggressive": 6, "moderate": 6, "conservative": 1, "speculator": 3}
    short = rows(scoring.shortlist(wanted, 2), "Investor Profile", "Rank", "CNPJ", "Score")
    assert short == [r for r in full if r[1] <= 2]
    nobody = scoring.eligible(scored.limit(0), marks, chars, S)
    assert rows(scoring.complete_ranking(nobody)) == []


def test_guardrails_separately_and_together(spark, day):
    scored = spark.createDataFrame([(i,) for i in (1, 1, 2, 3)], "cnpj long")
    chars = spark.createDataFrame([(1, "M"), (2, "N"), (3, None)], "cnpj long, fund_manager string")
    managers = spark.createDataFrame([("M", 5), ("N", 4)], "fund_manager string, num_funds long")
    sharpe = spark.createDataFrame(
        [(1, -1.0, 1.0, 0.7, 0.9), (2, 1.0, None, 0.8, 0.1)],
        "cnpj long, sharpe_12m double, sharpe_3m double, pct_cov_12m double, pct_cov_3m double",
    )
    returns = spark.createDataFrame([(1, day(0), 0.01), (2, day(1), -0.11), (2, day(2), 0.1)], RETURNS)
    on = {n: Guardrail(True, r.threshold) for n, r in S.guardrails.items()}
    last = day(2).isoformat()
    results = {
        "min_offer_per_issuer": guardrails.min_offer_per_issuer(scored, managers, chars, on["min_offer_per_issuer"]),
        "min_sharpe_12m": guardrails.min_sharpe(scored, sharpe, "12m", on["min_sharpe_12m"]),
        "min_sharpe_3m": guardrails.min_sharpe(scored, sharpe, "3m", on["min_sharpe_3m"]),
        "no_funds_wo_manager": guardrails.no_funds_without_manager(scored, chars, on["no_funds_wo_manager"]),
        "include_only_active_funds": guardrails.only_active_funds(scored, returns, last, on["include_only_active_funds"]),
        "no_extreme_returns": guardrails.no_extreme_returns(scored, returns, on["no_extreme_returns"]),
        "min_cov_sharpe_12m": guardrails.min_coverage(scored, sharpe, "12m", on["min_cov_sharpe_12m"]),
        "min_cov_sharpe_3m": guardrails.min_coverage(scored, sharpe, "3m", on["min_cov_sharpe_3m"]),
    }
    failing = {n: {r[0] for r in rows(df) if r[1]} for n, df in results.items()}
    assert failing == {
        "min_offer_per_issuer": {2, 3},
        "min_sharpe_12m": {1, 3},
        "min_sharpe_3m": {2, 3},
        "no_funds_wo_manager": {3},
        "include_only_active_funds": {1, 3},
        "no_extreme_returns": {2},
        "min_cov_sharpe_12m": {1, 3},
        "min_cov_sharpe_3m": {2, 3},
    }
    merged = rows(guardrails.merge_guardrails(results))
    assert merged[0] == (1, False, "min_sharpe_12m,include_only_active_funds,min_cov_sharpe_12m")
    off = guardrails.min_sharpe(scored, sharpe, "12m", Guardrail(False, 0.0))
    assert rows(off) == [(1, False), (2, False), (3, False)]

    seen = spark.createDataFrame([(1, False, 0.01), (2, True, 0.11)], "cnpj long, has_latest_data boolean, max_abs_return double")
    evidence = (
        guardrails.manager_sizes(chars, managers).join(sharpe, "cnpj", "left").join(seen, "cnpj", "left")
    )
    assert rows(guardrails.guardrail_mark(evidence, on)) == merged
    none = {n: Guardrail(False) for n in on}
    assert rows(guardrails.guardrail_mark(evidence, none)) == [(i, True, None) for i in (1, 2, 3)]
