"""Parameters of a run: investor profiles, rating scale, guardrails, scope lists.

Everything here is small, fixed configuration. It reaches Spark as literals, so
it never needs a join.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from types import MappingProxyType

# The seven scored features, each with the profile weight it uses.
FEATURE_WEIGHTS = MappingProxyType(
    {
        "volatility_score": "volatility",
        "sharpe_score": "risk_reward",
        "liquidity_score": "liquidity",
        "concentration_score": "concentration",
        "asset_diversification_score": "asset_diversification",
        "fund_age_score": "fund_age",
        "credit_quality_score": "credit_quality",
    }
)

# Credit ratings from best to worst.
RATING_ORDER = (
    "AAA+",
    "AAA",
    "BRAAA",
    "AAA(BR",
    "Aaa.br",
    "BRAA+",
    "AA+",
    "AA",
    "AA(BRA",
    "AA-(BR",
    "AA-",
    "A+(BRA",
    "A",
    "A-",
    "BBB+",
    "BAA2.B",
    "BBB-(B",
    "BRBBB-",
    "Ba1",
    "Ba2",
    "BA2.BR",
    "BB-",
)

# Names of the guardrails, in the order they are reported.
GUARDRAIL_NAMES = (
    "min_offer_per_issuer",
    "min_sharpe_12m",
    "min_sharpe_3m",
    "no_funds_wo_manager",
    "include_only_active_funds",
    "no_extreme_returns",
    "min_cov_sharpe_12m",
    "min_cov_sharpe_3m",
)


@dataclass(frozen=True)
class Profile:
    """Feature weights of one kind of investor, with optional allow-lists."""

    name: str
    liquidity: float
    risk_reward: float
    volatility: float
    concentration: float
    asset_diversification: float
    fund_age: float
    credit_quality: float = 0.0
    target_investor_profile: tuple[str, ...] | None = None
    allowed_fund_subtypes: tuple[str, ...] | None = None

    def __post_init__(self):
        total = sum(getattr(self, w) for w in FEATURE_WEIGHTS.values())
        if abs(total - 1.0) > 1e-9:
            raise ValueError(f"weights of profile {self.name!r} sum to {total}, not 1")


# The preset investor profiles.
DEFAULT_PROFILES = (
    Profile(
        "conservative",
        liquidity=0.10,
        risk_reward=0.10,
        volatility=0.25,
        concentration=0.10,
        asset_diversification=0.10,
        fund_age=0.20,
        credit_quality=0.15,
        allowed_fund_subtypes=(
            "Renda Fixa Simples",
            "Renda Fixa Indexados",
            "Renda Fixa Duração Baixa Soberano",
        ),
    ),
    Profile(
        "moderate",
        liquidity=0.13,
        risk_reward=0.35,
        volatility=0.13,
        concentration=0.08,
        asset_diversification=0.13,
        fund_age=0.08,
        credit_quality=0.10,
    ),
    Profile(
        "aggressive",
        liquidity=0.08,
        risk_reward=0.45,
        volatility=0.15,
        concentration=0.05,
        asset_diversification=0.13,
        fund_age=0.07,
        credit_quality=0.07,
    ),
    Profile(
        "speculator",
        liquidity=0.03,
        risk_reward=0.60,
        volatility=0.20,
        concentration=0.03,
        asset_diversification=0.03,
        fund_age=0.03,
        credit_quality=0.08,
        target_investor_profile=("Profissional",),
    ),
)


@dataclass(frozen=True)
class CreditRating:
    """Ordered rating scale and the weights of the credit-quality score."""

    order: tuple[str, ...] = RATING_ORDER
    investment_grade_threshold: str = "BRBBB-"
    weight_avg_rating_score: float = 0.4
    weight_investment_grade: float = 0.6

    def score_of(self, position: int) -> float:
        return (len(self.order) - position) / len(self.order)

    @property
    def investment_grade(self) -> tuple[str, ...]:
        last = self.order.index(self.investment_grade_threshold)
        return self.order[: last + 1]


@dataclass(frozen=True)
class Guardrail:
    active: bool = False
    threshold: float | None = None


# Which guardrails apply by default, with their thresholds.
DEFAULT_GUARDRAILS = MappingProxyType(
    {
        "min_offer_per_issuer": Guardrail(True, 5),
        "min_sharpe_12m": Guardrail(False, 0.0),
        "min_sharpe_3m": Guardrail(False, 0.0),
        "no_funds_wo_manager": Guardrail(False),
        "include_only_active_funds": Guardrail(True),
        "no_extreme_returns": Guardrail(True, 0.10),
        "min_cov_sharpe_12m": Guardrail(True, 0.80),
        "min_cov_sharpe_3m": Guardrail(True, 0.80),
    }
)


@dataclass(frozen=True)
class Settings:
    """All parameters of a run. The defaults are fixed values."""

    max_period: int | None = None
    max_ref_date: str | None = None
    as_of: str | None = None
    trading_days_12m: int = 252
    trading_days_3m: int = 63
    n_top_funds_output: int = 5
    num_period_months: int | None = None
    remove_funds_w_negative_nav: bool = True
    fund_types: tuple[str, ...] = ("CLASSES - FIF", "FI")
    registry_categories: tuple[str, ...] = ("Renda Fixa",)
    accessability: tuple[str, ...] = ("Não Há Restrição", "Não há Restrição")
    #: Collation by which texts of the registry and the lists above and of profiles are compared, for
    #: instance UNICODE_CI_AI, which ignores case and accents; None compares them as they are.
    collation: str | None = None
    risk_free_rate_annual: float = 0.1371
    fund_age_cap_years: float = 30.0
    gamma_coverage_penalty: float = 0.7
    normalization_lower_percentile: float = 0.05
    normalization_upper_percentile: float = 0.95
    use_log_volatility: bool = True
    epsilon_volatility: float = 1e-6
    sharpe_cap: float = 20.0
    credit_rating: CreditRating = field(default_factory=CreditRating)
    profiles: tuple[Profile, ...] = DEFAULT_PROFILES
    guardrails: MappingProxyType = DEFAULT_GUARDRAILS

    @property
    def risk_free_rate_daily(self) -> float:
        return (1 + self.risk_free_rate_annual) ** (1 / self.trading_days_12m) - 1
