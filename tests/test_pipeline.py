"""The whole run over files on disk, and its independence from partitioning."""

import datetime as dt
from functools import reduce

import pytest
from pyspark.sql import DataFrame

from fundsift.config import Profile, Settings
from fundsift.operators import quality
from fundsift.plans import pipeline
from fundsift.session import materialize
from fundsift.sources import files

from .conftest import rows
from .test_files_repair import NEW, OLD, put

FUNDS = range(1, 9)


def cnpj(i):
    return f"{i:02d}.000.000/0001-00"


@pytest.fixture(scope="module")
def raw_root(tmp_path_factory):
    root = tmp_path_factory.mktemp("raw")
    for month, header in ((202401, OLD), (202402, NEW)):
        last = "2024-01-31" if month == 202401 else "2024-02-29"
        lines = [f'FI;{cnpj(i)};FUND "{i}";{last};{-1 if i == 8 else 100 * i}' for i in FUNDS]
        lines.append(f'FI;{cnpj(1)};ODD",;2024-01-15;5')
        put(root / "monthly" / "pl", f"{month}.csv", [header, *lines])
        ids = header.split(";")[:2]
        for k in range(1, 8):
            head = ";".join([*ids, "TP_ATIVO", "VL_MERC_POS_FINAL"])
            extra = ";CNPJ_EMISSOR;AG_RISCO;GRAU_RISCO" if k == 5 else ""
            body = [
                f"FI;{cnpj(i)};type {(i + k) % 3};{10 * i + k}" + (f";{cnpj(9)};ag;{'AAA+' if i % 2 else 'Ba1'}" if k == 5 else "")
                for i in FUNDS
            ]
            put(root / "monthly" / f"blc_{k}", f"{month}.csv", [head + extra, *body])
    day = dt.date(2024, 1, 1)
    months: dict[str, list[str]] = {}
    for n in range(60):
        date = day + dt.timedelta(days=n)
        for i in FUNDS:
            quota = 100 + n * 0.01 * i + ((n * i) % 5) * 0.02
            months.setdefault(f"{date:%Y%m}", []).append(f"FI;{cnpj(i)};{date};{quota};{100 * i}")
    for month, lines in months.items():
        put(root / "daily" / "quotas", f"{month}.csv", ["TP_FUNDO;CNPJ_FUNDO;DT_COMPTC;VL_QUOTA;VL_PATRIM_LIQ", *lines])
    head = "CNPJ do Fundo;Categoria ANBIMA;nivel_1_categoria;nivel_2_categoria;nivel_3_subcategoria;" \
        "Característica do Investidor;Tipo ANBIMA;Tipo de Investidor;Gestor Principal;Nome Comercial;" \
        "Prazo Pagamento Resgate em dias;Status;Data de Início de Atividade"
    lines = [
        f"{i}000000{1:04d}00;Renda Fixa;RF;Alta;Livre;Profissional;Renda Fixa Simples;Não Há Restrição;"
        f"M;Fund {i};{i * 10}.0;{'Encerrado' if i == 7 else 'Ativo'};20{10 + i}-01-01"
        for i in FUNDS
    ]
    (root / "registry.csv").write_text("\n".join([head, *lines]) + "\n")
    return root


SETTINGS = Settings(as_of="2024-03-01", trading_days_12m=50, trading_days_3m=20)


@pytest.fixture(scope="module")
def tables(spark, raw_root):
    raw = pipeline.read_raw(spark, str(raw_root), str(raw_root / "registry.csv"), SETTINGS)
    stored = pipeline.Raw(
        materialize(raw.monthly_nav),
        materialize(raw.daily_quotas),
        {name: materialize(df) for name, df in raw.holdings.items()},
        materialize(raw.registry),
    )
    return stored, pipeline.with_reference_dates(stored, SETTINGS)


@pytest.fixture(scope="module")
def result(tables):
    return pipeline.run(tables[0], SETTINGS)


def test_reference_dates(tables):
    _, settings = tables
    assert (settings.max_period, settings.max_ref_date) == (202402, "2024-02-29")


def test_run(result, tmp_path):
    marks = rows(result.guardrail_mark)
    # Fund 8 has a negative NAV at the end of the period, fund 7 is closed.
    assert [m[0] for m in marks] == [int(f"{i}000000000100") for i in range(1, 7)]
    assert all(m[1] for m in marks)
    scores = result.scores.collect()
    assert len(scores) == 24 and all(0 <= r.score <= 1 for r in scores)
    for profile in ("conservative", "speculator"):
        ranks = sorted(r.rank for r in scores if r.investor_profile == profile)
        assert ranks == [1, 2, 3, 4, 5, 6]
    assert result.complete_ranking.count() == 24
    assert result.shortlist.count() == 20
    pipeline.write_results(result, str(tmp_path))
    assert {p.name for p in tmp_path.iterdir()} == {
        "scores_per_profile", "guardrail_mark", "shortlist", "complete_ranking"
    }


def test_checks(tables):
    raw, settings = tables
    inter = pipeline.intermediate(raw, settings)
    prim = pipeline.primary_tables(inter, raw.registry, settings)
    results = pipeline.check_tables(raw, inter, prim)
    failed = rows(quality.validation_report(results), "dataset_name", "validation_name", "error_count")
    assert failed == [
        ("monthly_nav/202401.csv", "validate_bounds", 1),
        ("monthly_nav/202402.csv", "validate_bounds", 1),
        ("monthly_pl", "validate_uniqueness", 1),
        ("nav_per_period", "validate_uniqueness", 1),
    ]


def test_stored_run(spark, tables, result, raw_root, tmp_path):
    raw, settings = tables
    lines = files.raw_lines(spark, f"{raw_root}/monthly/pl")
    together = reduce(DataFrame.unionByName, lines.values())
    root = str(tmp_path / "run")
    ranking = pipeline.run_and_store(raw, SETTINGS, root, {"pl": together})
    assert rows(ranking.complete_ranking) == rows(result.complete_ranking)
    report = spark.read.parquet(f"{root}/reports/quality")
    failed = rows(report.filter("status = 'failed'"), "dataset_name", "validation_name", "error_count")
    assert len(failed) == 4 and report.count() > 10
    assert spark.read.parquet(f"{root}/reports/quality_affected").count() >= 4
    assert spark.read.parquet(f"{root}/reports/repair").count() == 2 * together.select("file").distinct().count()
    assert spark.read.parquet(f"{root}/reports/repair_affected").columns == ["file", "validation_name", "line_no"]
    inter = pipeline.load(pipeline.Intermediate, spark, f"{root}/intermediate")
    again = pipeline.primary_tables(inter, raw.registry, settings)
    assert rows(again.daily_nav) == rows(pipeline.load(pipeline.Primary, spark, f"{root}/primary").daily_nav)


@pytest.mark.parametrize("partitions", ["1", "7"])
def test_any_number_of_partitions_gives_the_same(spark, tables, result, partitions):
    raw, _ = tables
    want = rows(result.complete_ranking)
    assert len(want) == 24
    keep = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        assert rows(pipeline.run(raw, SETTINGS).complete_ranking) == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", keep)


def test_own_profiles(tables):
    from dataclasses import replace

    raw, _ = tables
    mine = Profile("mine", 0.2, 0.3, 0.2, 0.1, 0.1, 0.1, target_investor_profile=("Geral",))
    result = pipeline.run(raw, replace(SETTINGS, profiles=(mine,)))
    assert result.scores.count() == 6
    assert result.complete_ranking.count() == 0


def test_raw_files_with_line_breaks(spark, raw_root, tmp_path):
    """Monthly names over two lines; the other files as they are."""
    for kind in ("daily/quotas", *(f"monthly/blc_{k}" for k in range(1, 8))):
        (tmp_path / kind).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / kind).symlink_to(raw_root / kind)
    lines = [f'FI;{cnpj(i)};"FUND\n{i}";2024-01-31;{100 * i}' for i in FUNDS]
    put(tmp_path / "monthly" / "pl", "202401.csv", [OLD, *lines])
    raw = pipeline.read_raw(spark, str(tmp_path), str(raw_root / "registry.csv"), SETTINGS, repaired=False, line_breaks=True)
    assert rows(raw.monthly_nav, "DENOM_SOCIAL", "VL_PATRIM_LIQ") == [(f"FUND\n{i}", 100.0 * i) for i in FUNDS]
    assert raw.holdings["blc_5"].count() == 2 * len(FUNDS)
    assert raw.latest_period == 202402
    with pytest.raises(ValueError, match="cannot be repaired"):
        pipeline.read_raw(spark, str(tmp_path), "registry.csv", SETTINGS, line_breaks=True)
