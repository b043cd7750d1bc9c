"""Options of a deployment, from the environment or from code."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, field, replace

from tidemark.schemas import TABLES, TableSpec


@dataclass(frozen=True)
class JdbcTarget:
    """Where a JDBC reader or writer connects."""

    url: str
    driver: str
    user: str = "default"
    password: str = field(default="", repr=False)
    batch_size: int = 100_000

    def options(self) -> dict[str, str]:
        return {
            "url": self.url,
            "driver": self.driver,
            "user": self.user,
            "password": self.password,
        }


# The names and defaults that deployments of the original already set.
def clickhouse_target(env: Mapping[str, str]) -> JdbcTarget:
    host = env.get("CLICKHOUSE_HOST", "clickhouse")
    port = int(env.get("CLICKHOUSE_PORT", "8123"))
    database = env.get("CLICKHOUSE_DB", "default")
    return JdbcTarget(
        url=f"jdbc:clickhouse://{host}:{port}/{database}",
        driver="com.clickhouse.jdbc.ClickHouseDriver",
        user=env.get("CLICKHOUSE_USER", "default"),
        password=env.get("CLICKHOUSE_PASSWORD", ""),
    )


@dataclass(frozen=True)
class PipelineConfig:
    bootstrap_servers: str = "kafka1:9092"
    topics: Mapping[str, str] = field(
        default_factory=lambda: {name: spec.topic for name, spec in TABLES.items()}
    )
    starting_offsets: str = "earliest"
    max_offsets_per_trigger: int | None = None
    min_partitions: int | None = None
    app_name: str = "Change log processing"
    master: str | None = None
    shuffle_partitions: int | None = None
    checkpoint_location: str | None = None
    checkpoint_version: int = 1
    trigger_interval: str = "10 seconds"
    debug: bool = False
    long_ids: bool = False
    sink: str = "log"
    compact_every: int | None = 60
    drop_folded: bool = False
    tombstone_days: int | None = None
    repeats_within: str | None = None
    jdbc: JdbcTarget | None = None

    @classmethod
    def from_env(cls, env: Mapping[str, str] | None = None) -> PipelineConfig:
        env = os.environ if env is None else env
        base = cls(jdbc=clickhouse_target(env))

        def number(name: str, default: int | None = None) -> int | None:
            return int(env[name]) if env.get(name) else default

        def switch(name: str) -> bool:
            return env.get(name, "false").strip().lower() == "true"

        return replace(
            base,
            bootstrap_servers=env.get("KAFKA_SERVERS", base.bootstrap_servers),
            app_name=env.get("SPARK_APP_NAME", base.app_name),
            master=env.get("SPARK_MASTER"),
            shuffle_partitions=number("SPARK_SHUFFLE_PARTITIONS"),
            starting_offsets=env.get("STARTING_OFFSETS", base.starting_offsets),
            max_offsets_per_trigger=number("MAX_OFFSETS_PER_TRIGGER"),
            min_partitions=number("MIN_PARTITIONS"),
            checkpoint_location=env.get("CHECKPOINT_LOCATION"),
            checkpoint_version=number("CHECKPOINT_VERSION", base.checkpoint_version),
            trigger_interval=env.get("TRIGGER_INTERVAL", base.trigger_interval),
            debug=switch("DEBUG_MODE"),
            long_ids=switch("LONG_IDS"),
            sink=env.get("CHANGE_SINK", base.sink),
            compact_every=number("COMPACT_EVERY", base.compact_every),
            drop_folded=switch("DROP_FOLDED"),
            tombstone_days=number("TOMBSTONE_DAYS"),
            repeats_within=env.get("REPEATS_WITHIN") or None,
        )

    def validate(self) -> PipelineConfig:
        """Raise ``ValueError`` on the first missing setting."""
        if not self.bootstrap_servers:
            raise ValueError("no bootstrap servers given")
        if not self.app_name:
            raise ValueError("no application name given")
        if self.jdbc is not None and not self.jdbc.url:
            raise ValueError("no JDBC URL given")
        unknown = set(self.topics) - set(TABLES)
        if unknown:
            raise ValueError(f"topics for unknown tables: {sorted(unknown)}")
        if self.sink not in ("log", "jdbc"):
            raise ValueError(f"sink {self.sink!r} is neither 'log' nor 'jdbc'")
        if self.sink == "jdbc" and self.jdbc is None:
            raise ValueError("no JDBC target given")
        for name in ("compact_every", "tombstone_days"):
            if getattr(self, name) is not None and getattr(self, name) < 1:
                raise ValueError(f"{name} has to be 1 or more")
        if self.checkpoint_version < 1:
            raise ValueError("checkpoint versions start at 1")
        return self

    def spec(self, table: str) -> TableSpec:
        if table not in self.topics:
            raise ValueError(f"unknown table {table!r}; known: {sorted(self.topics)}")
        spec = TABLES[table].with_long_ids() if self.long_ids else TABLES[table]
        return spec.on_topic(self.topics[table])

    def checkpoint_for(self, table: str, root: str) -> str:
        """``<root>/<table>/v<N>``: one rule for every table."""
        return f"{(self.checkpoint_location or root).rstrip('/')}/{table}/v{self.checkpoint_version}"
