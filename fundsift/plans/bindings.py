"""The benchmark star schema in the roles of the fund tables.

A supplier is a fund and a nation its manager; a line item is a daily quota row and a
portfolio position; a document is a delimited text file. The mapping is made up but
deterministic. Columns carry the names that the operators expect.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, replace
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fundsift.config import RATING_ORDER, Settings
from fundsift.functions.columns import cnpj_to_formatted, period_of
from fundsift.operators import features, holdings, primary, registry
from fundsift.plans.pipeline import Raw, evidence_per_fund
from fundsift.session import materialize, stored_bytes

AS_OF = "2002-01-01"


def ship_date() -> Column:
    return F.to_date("l_shipdate")


def fund_type(region: str = "r_name") -> Column:
    return (
        F.when(F.col(region) == "ASIA", "FACFIF")
        .when(F.col(region) == "EUROPE", "FI")
        .otherwise("CLASSES - FIF")
    )


#: Splits of a folder that is read in many parts, and bytes of one at most.
SPLITS = 48
LARGEST_SPLIT = 1 << 27


def split_size(spark: SparkSession, path: str, least: int) -> int:
    """Bytes of a split of the files below ``path``: ``least`` for small files, and about ``SPLITS`` parts of larger ones.

    Every part is a task of each job that reads it, so there are no more of them than the work needs.
    """
    return max(least, min(stored_bytes(spark, path) // SPLITS, LARGEST_SPLIT))


@contextmanager
def small_splits(spark: SparkSession, size: int) -> Iterator[None]:
    """Files are read in parts of ``size`` bytes by the jobs that run inside."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {name: spark.conf.get(name) for name in names}
    try:
        for name in names:
            spark.conf.set(name, str(size))
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


@dataclass(frozen=True)
class Tables:
    """Roles over one folder of the star schema."""

    spark: SparkSession
    folder: str

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def latest_ship_date(self):
        return self.read("lineitem").agg(F.max(ship_date())).first()[0]

    @cached_property
    def settings(self) -> Settings:
        """Defaults with the reference dates of the data.

        The latest period is the month before the last ship date, which has few rows.
        """
        last = self.latest_ship_date
        year, month = (last.year, last.month - 1) if last.month > 1 else (last.year - 1, 12)
        return replace(
            Settings(),
            max_period=year * 100 + month,
            max_ref_date=last.isoformat(),
            as_of=AS_OF,
        )

    @property
    def latest_period(self) -> int:
        return self.settings.max_period

    # -- facts ---------------------------------------------------------------

    def quotas(self) -> DataFrame:
        """Daily quotas with numeric fund ids; no share class on open line items.

        Some quotas are missing, zero or negative, and some funds have few usable days.
        """
        order = F.col("l_orderkey")
        unusable = (order % 23 == 0) | ((F.col("l_suppkey") % 9 == 4) & (order % 40 != 1))
        return self.read("lineitem").select(
            F.col("l_suppkey").alias("cnpj"),
            ship_date().alias("DT_COMPTC"),
            F.when(unusable, None)
            .when(order % 29 == 0, 0.0)
            .when(order % 31 == 0, -F.col("l_extendedprice"))
            .otherwise(F.lit(100) + F.col("l_extendedprice") / 10000)
            .alias("VL_QUOTA"),
            F.col("l_extendedprice").alias("VL_PATRIM_LIQ"),
            F.when(F.col("l_linestatus") == "F", F.col("l_returnflag")).alias("ID_SUBCLASSE"),
        )

    def raw_quotas(self) -> DataFrame:
        """Daily quotas as they come: fund ids as text, old column names, period."""
        return (
            self.quotas()
            .withColumns(
                {
                    "CNPJ_FUNDO": cnpj_to_formatted("cnpj"),
                    "period": period_of("DT_COMPTC"),
                }
            )
            .drop("cnpj")
        )

    def funds(self) -> DataFrame:
        return self.read("supplier").select(F.col("s_suppkey").alias("cnpj"))

    def places(self) -> DataFrame:
        """Nations with their regions; as many rows as there are nations."""
        return self.read("nation").join(
            self.read("region"), F.col("n_regionkey") == F.col("r_regionkey")
        )

    def suppliers(self) -> DataFrame:
        return self.read("supplier").join(
            self.places(), F.col("s_nationkey") == F.col("n_nationkey")
        )

    def raw_monthly_nav(self) -> DataFrame:
        """Month-end NAV per fund, negative for suppliers with a negative balance."""
        monthly = (
            self.read("lineitem")
            .groupBy("l_suppkey", F.last_day(ship_date()).alias("DT_COMPTC"))
            .agg(F.round(F.sum("l_extendedprice"), 2).alias("total"))
        )
        owners = self.suppliers().select(
            "s_suppkey",
            cnpj_to_formatted("s_suppkey").alias("CNPJ_FUNDO"),
            "s_name",
            "s_acctbal",
            "r_name",
        )
        return monthly.join(owners, F.col("l_suppkey") == F.col("s_suppkey")).select(
            fund_type().alias("TP_FUNDO"),
            "CNPJ_FUNDO",
            F.col("s_name").alias("DENOM_SOCIAL"),
            "DT_COMPTC",
            F.when(F.col("s_acctbal") <= 0, -F.col("total"))
            .otherwise(F.col("total"))
            .alias("VL_PATRIM_LIQ"),
            period_of("DT_COMPTC").alias("period"),
        )

    def monthly_prices(self) -> DataFrame:
        """(cnpj, DT_COMPTC, VL_PATRIM_LIQ); some rows occur twice, some months have two prices."""
        monthly = (
            self.read("lineitem")
            .groupBy(F.col("l_suppkey").alias("cnpj"), F.last_day(ship_date()).alias("DT_COMPTC"))
            .agg(F.round(F.sum("l_extendedprice"), 2).alias("VL_PATRIM_LIQ"))
        )
        added = (
            F.when(F.col("cnpj") % 7 == 0, F.array(F.lit(0.0), F.lit(0.0)))
            .when(F.col("cnpj") % 11 == 0, F.array(F.lit(0.0), F.lit(1000.0)))
            .otherwise(F.array(F.lit(0.0)))
        )
        return monthly.withColumn("_added", F.explode(added)).select(
            "cnpj", "DT_COMPTC", F.round(F.col("VL_PATRIM_LIQ") + F.col("_added"), 2).alias("VL_PATRIM_LIQ")
        )

    def _rating(self) -> Column:
        """Brands in order take the ratings in order; brands beyond them are unrated."""
        number = F.regexp_extract("p_brand", r"(\d+)$", 1).cast("int")
        scale = F.array(*[F.lit(r) for r in RATING_ORDER])
        return F.coalesce(F.get(scale, number - 1), F.lit("F"))

    def _positions(self, fund_id: Column, fund_id_name: str) -> DataFrame:
        priced = self.read("lineitem").join(
            self.read("part").select("p_partkey", "p_type", "p_brand"),
            F.col("l_partkey") == F.col("p_partkey"),
        )
        rated = F.col("l_linenumber") == 5
        # Some positions occur twice.
        copies = F.when(F.col("l_orderkey") % 13 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
        priced = priced.withColumn("_copy", F.explode(copies))
        return priced.select(
            fund_id.alias(fund_id_name),
            "l_linenumber",
            period_of(ship_date()).alias("period"),
            F.col("p_type").alias("TP_ATIVO"),
            F.when(F.col("l_returnflag") == "R", -F.col("l_extendedprice"))
            .otherwise(F.col("l_extendedprice"))
            .alias("VL_MERC_POS_FINAL"),
            F.col("l_quantity").alias("QT_POS_FINAL"),
            F.when(rated, cnpj_to_formatted("l_partkey")).alias("CNPJ_EMISSOR"),
            F.when(rated, F.col("p_brand")).alias("AG_RISCO"),
            F.when(rated, self._rating()).alias("GRAU_RISCO"),
        )

    def positions(self) -> DataFrame:
        """All holdings, the family given by the line number."""
        return self._positions(F.col("l_suppkey"), "cnpj").select(
            "cnpj",
            F.concat(F.lit("blc_"), F.col("l_linenumber")).alias("blc_type"),
            "period",
            "TP_ATIVO",
            "VL_MERC_POS_FINAL",
            "QT_POS_FINAL",
            "CNPJ_EMISSOR",
            "AG_RISCO",
            "GRAU_RISCO",
        )

    def raw_families(self) -> dict[str, DataFrame]:
        """Holdings by family, each with the columns its files have."""
        rows = self._positions(cnpj_to_formatted("l_suppkey"), "CNPJ_FUNDO")
        rated = ["CNPJ_EMISSOR", "AG_RISCO", "GRAU_RISCO"]
        return {
            f"blc_{i}": rows.filter(F.col("l_linenumber") == i).drop(
                "l_linenumber", *([] if i == 5 else rated)
            )
            for i in range(1, 8)
        }

    def raw_holdings(self) -> DataFrame:
        """Holdings of all families as one table, read once."""
        rows = self._positions(cnpj_to_formatted("l_suppkey"), "CNPJ_FUNDO")
        return rows.withColumn("blc_type", F.concat(F.lit("blc_"), "l_linenumber")).drop("l_linenumber")

    def registry(self) -> DataFrame:
        """One registry row per supplier and return flag seen, as share classes are."""
        seen = (
            self.read("lineitem")
            .groupBy("l_suppkey", "l_returnflag")
            .agg(F.min(ship_date()).alias("first_seen"))
        )
        balance = F.col("s_acctbal")
        return seen.join(self.suppliers(), F.col("l_suppkey") == F.col("s_suppkey")).select(
            F.col("s_suppkey").alias("CNPJ do Fundo"),
            F.when(F.col("r_name") == "MIDDLE EAST", "Multimercados")
            .otherwise("Renda Fixa")
            .alias("Categoria ANBIMA"),
            F.col("r_name").alias("nivel_1_categoria"),
            F.col("n_name").alias("nivel_2_categoria"),
            F.when(balance > 6000, "Duração Alta - Crédito Livre")
            .when(balance > 3000, "Duração Média (Soberano)")
            .when(balance > 0, "Simples")
            .alias("nivel_3_subcategoria"),
            F.when(balance > 5000, "Profissional")
            .otherwise("Qualificado")
            .alias("Característica do Investidor"),
            F.when(F.col("r_name") == "AFRICA", "Renda Fixa Simples")
            .when(F.col("r_name") == "EUROPE", "Renda Fixa Indexados")
            .otherwise(F.col("r_name"))
            .alias("Tipo ANBIMA"),
            F.when(balance > 9500, "Restrito")
            .when(F.col("r_name") == "EUROPE", "Não há Restrição")
            .otherwise("Não Há Restrição")
            .alias("Tipo de Investidor"),
            F.when(balance <= 9000, F.col("n_name")).alias("Gestor Principal"),
            F.concat_ws(" ", "s_name", "l_returnflag").alias("Nome Comercial"),
            F.when(balance <= 8500, F.col("s_nationkey").cast("double")).alias(
                "Prazo Pagamento Resgate em dias"
            ),
            F.when(balance > 0, "Ativo").otherwise("Inativo").alias("Status"),
            F.date_format("first_seen", "yyyy-MM-dd").alias("Data de Início de Atividade"),
        )

    def raw(self) -> Raw:
        return Raw(
            monthly_nav=self.raw_monthly_nav(),
            daily_quotas=self.raw_quotas(),
            holdings=self.raw_holdings(),
            registry=self.registry(),
        )

    def document_lines(self) -> DataFrame:
        """Every document as a delimited file: commas part fields, k and x turn to quotes."""
        text = F.replace(F.col("text"), F.lit(","), F.lit(";"))
        text = F.replace(text, F.lit("k"), F.lit('"'))
        text = F.replace(text, F.lit("x"), F.lit('""'))
        return self.read("documents").select(
            F.col("doc_id").cast("string").alias("file"),
            F.lit(0).cast("long").alias("block"),
            F.posexplode(F.split(text, "\n")).alias("pos", "line"),
        ).select(
            "file",
            "block",
            F.col("pos").cast("long").alias("seq"),
            (F.col("pos") == 0).alias("is_header"),
            "line",
        )

    # -- derived tables that several queries start from -----------------------

    def daily_nav(self) -> DataFrame:
        return primary.daily_nav(self.quotas())

    def returns(self) -> DataFrame:
        return primary.daily_returns(self.daily_nav())

    def instruments(self) -> DataFrame:
        return holdings.instrument_registry(self.positions())

    def prices(self) -> DataFrame:
        return holdings.instrument_prices(self.instruments(), self.latest_period)

    def characteristics(self) -> DataFrame:
        return registry.fund_characteristics(self.registry(), self.funds())

    @cached_property
    def stored_characteristics(self) -> DataFrame:
        return materialize(self.characteristics())

    @cached_property
    def evidence(self) -> DataFrame:
        """Features and guardrail evidence of all suppliers, stored."""
        return materialize(
            evidence_per_fund(
                self.returns(),
                self.positions(),
                self.stored_characteristics,
                registry.fund_managers(self.stored_characteristics),
                self.settings,
            )
        )

    def sharpe(self) -> DataFrame:
        return features.sharpe_ratio(self.returns(), self.latest_period, self.settings)

