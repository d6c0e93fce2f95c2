"""Settings of the operators: frozen values, passed in explicitly."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, field, replace


@dataclass(frozen=True)
class SignalSettings:
    """Spike and trend detection."""

    spike_threshold_pct: float = 0.5
    trend_count: int = 5
    cooldown_seconds: int = 300


@dataclass(frozen=True)
class GapSettings:
    """Arbitrage gap between a local price and the one implied by two other feeds."""

    global_symbol: str = "XAU/USD"
    rate_symbol: str = "USD/EGP"
    local_symbol: str = "XAU/EGP_LOCAL"
    alert_symbol: str = "XAU_GAP"
    purity: float = 0.875
    grams_per_ounce: float = 31.1035
    threshold: float = 60.0
    min_change: float = 50.0
    cooldown_seconds: int = 3600
    stale_global_seconds: int = 300
    stale_local_seconds: int = 180

    @property
    def legs(self) -> tuple[str, str, str]:
        return self.global_symbol, self.rate_symbol, self.local_symbol


@dataclass(frozen=True)
class SeveritySettings:
    """Lower bounds of the severity bands, on ``change_amount``."""

    gap_high: float = 300.0
    gap_medium: float = 150.0
    move_high: float = 200.0
    move_medium: float = 120.0


@dataclass(frozen=True)
class OutlierSettings:
    """Largest accepted move from the last accepted price, in percent."""

    threshold_pct: float = 10.0
    per_symbol_pct: Mapping[str, float] = field(default_factory=dict)


@dataclass(frozen=True)
class HealthSettings:
    max_silence_seconds: Mapping[str, int] = field(
        default_factory=lambda: {"XAU/USD": 600, "USD/EGP": 600, "XAU/EGP_LOCAL": 300}
    )
    max_lag_seconds: int = 300
    check_interval_seconds: int = 300
    heartbeat_hour: int = 9


@dataclass(frozen=True)
class AlertJobSettings:
    poll_interval_seconds: int = 30
    lookback_hours: int = 1


@dataclass(frozen=True)
class KafkaSettings:
    servers: str = "localhost:9094"
    topic: str = "market_prices"


@dataclass(frozen=True)
class Settings:
    signals: SignalSettings = SignalSettings()
    gap: GapSettings = GapSettings()
    severity: SeveritySettings = SeveritySettings()
    outliers: OutlierSettings = OutlierSettings()
    health: HealthSettings = field(default_factory=HealthSettings)
    alert_job: AlertJobSettings = AlertJobSettings()
    kafka: KafkaSettings = KafkaSettings()
    display_zone: str = "Africa/Cairo"


def settings_from_env(environ: Mapping[str, str] | None = None) -> Settings:
    """Defaults overridden by the environment variables an operator already has set."""
    env = os.environ if environ is None else environ

    def pick(current, **names):
        found = {
            attr: type(getattr(current, attr))(env[name])
            for attr, name in names.items()
            if name in env
        }
        return replace(current, **found)

    base = Settings()
    silence = dict(base.health.max_silence_seconds)
    for symbol, name in (
        ("XAU/USD", "HEALTH_MAX_SILENCE_XAU_USD"),
        ("USD/EGP", "HEALTH_MAX_SILENCE_USD_EGP"),
        ("XAU/EGP_LOCAL", "HEALTH_MAX_SILENCE_LOCAL"),
    ):
        silence[symbol] = int(env.get(name, silence[symbol]))
    health = pick(
        base.health,
        max_lag_seconds="HEALTH_MAX_LAG_SECONDS",
        check_interval_seconds="HEALTH_CHECK_INTERVAL",
    )
    return replace(
        base,
        signals=pick(
            base.signals,
            spike_threshold_pct="SPIKE_THRESHOLD",
            trend_count="TREND_COUNT",
            cooldown_seconds="ALERT_COOLDOWN",
        ),
        gap=pick(
            base.gap,
            threshold="GAP_THRESHOLD",
            min_change="MIN_GAP_CHANGE",
            cooldown_seconds="GAP_COOLDOWN",
            stale_global_seconds="STALE_PRICE_SECONDS",
            stale_local_seconds="LOCAL_PRICE_MAX_AGE_SECONDS",
        ),
        severity=pick(
            base.severity, gap_high="GAP_SEVERITY_HIGH", gap_medium="GAP_SEVERITY_MEDIUM"
        ),
        outliers=pick(base.outliers, threshold_pct="PRICE_OUTLIER_THRESHOLD_PCT"),
        health=replace(health, max_silence_seconds=silence),
        alert_job=pick(
            base.alert_job,
            poll_interval_seconds="ALERT_POLL_INTERVAL",
            lookback_hours="ALERT_LOOKBACK_HOURS",
        ),
        kafka=pick(base.kafka, servers="KAFKA_BOOTSTRAP_SERVERS", topic="KAFKA_TOPIC"),
    )
