"""Where the layers of one table live."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass


@dataclass(frozen=True)
class Layers:
    """Paths under ``base``, whose scheme (``file:``, ``hdfs:``, ``s3a:`` ...) Spark resolves."""

    base: str
    table: str = "orders"

    @classmethod
    def from_env(cls, table: str = "orders", env: Mapping[str, str] | None = None) -> Layers:
        env = os.environ if env is None else env
        # fixed values: variable name and local fallback of the storage contract
        return cls(env.get("CLOUD_STORAGE_PATH", "./storage"), table)

    def path(self, layer: str) -> str:
        return f"{self.base.rstrip('/')}/{layer}/{self.table}"

    @property
    def bronze(self) -> str:
        return self.path("bronze")

    @property
    def silver(self) -> str:
        return self.path("silver")

    @property
    def quarantine(self) -> str:
        return self.path("quarantine")

    @property
    def gold(self) -> str:
        return self.path("gold")

    @property
    def marks(self) -> str:
        return self.path("marks")

    @property
    def replayed(self) -> str:
        return self.path("replayed")

    @property
    def profiles(self) -> str:
        return self.path("profiles")
