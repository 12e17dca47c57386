"""Typed settings of a run with a fingerprint: a resumed run under other settings is refused."""

from __future__ import annotations

import hashlib
import json
from dataclasses import asdict, dataclass, replace

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Settings:
    """Thresholds of the gates and the near-duplicate stage; values are checked on creation."""

    min_chars: int = 100
    max_chars: int = 100_000
    min_alpha: float = 0.5
    similarity: float = 0.8
    keep_score: float = 0.45
    rewrite_score: float = 0.3
    domain_cap: float = 0.15
    soft_overflow: float = 0.15

    def __post_init__(self) -> None:
        if not 0 <= self.min_chars <= self.max_chars:
            raise ValueError("min_chars must lie between 0 and max_chars")
        for name in ("min_alpha", "similarity", "keep_score", "rewrite_score", "domain_cap", "soft_overflow"):
            if not 0 <= getattr(self, name) <= 1:
                raise ValueError(f"{name} must lie between 0 and 1")

    def fingerprint(self) -> str:
        return hashlib.sha256(json.dumps(asdict(self), sort_keys=True).encode()).hexdigest()

    def with_values(self, **values) -> Settings:
        """A copy with some values replaced, the others inherited."""
        return replace(self, **values)


def pin(spark: SparkSession, folder: str, settings: Settings) -> bool:
    """Write the fingerprint of a new run folder, or compare it with that of an old one; raises where they differ.

    True where the folder is new.
    """
    path = f"{folder}/settings"
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    if p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p):
        old = spark.read.text(path).first()[0]
        if old != settings.fingerprint():
            raise ValueError("the run folder was made under other settings")
        return False
    spark.createDataFrame([(settings.fingerprint(),)], "value string").coalesce(1).write.text(path)
    return True
