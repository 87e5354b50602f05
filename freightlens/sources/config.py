"""Run configuration: YAML or a dict, with ${NAME:-default} taken from the environment."""

from __future__ import annotations

import os
import re
from collections.abc import Mapping
from pathlib import Path
from typing import Any

from pyspark.sql import SparkSession

_NAME = re.compile(r"\$\{(\w+)(?::-([^}]*))?\}")


def expand(value: Any, env: Mapping[str, str] = os.environ) -> Any:
    """Replaces ${NAME} and ${NAME:-default} in all texts; a name without value or default is an error."""
    if isinstance(value, dict):
        return {k: expand(v, env) for k, v in value.items()}
    if isinstance(value, list):
        return [expand(v, env) for v in value]
    if not isinstance(value, str):
        return value

    def put(m: re.Match) -> str:
        if m[1] in env:
            return env[m[1]]
        if m[2] is None:
            raise KeyError(f"{m[1]} is not set")
        return m[2]

    return _NAME.sub(put, value)


def load_config(path: str | Path, env: Mapping[str, str] = os.environ) -> dict:
    import yaml

    return expand(yaml.safe_load(Path(path).read_text()) or {}, env)


def truth(value: Any) -> bool:
    """Booleans as people write them."""
    return value if isinstance(value, bool) else str(value or "").strip().lower() in {"1", "true", "yes", "y", "on"}


def run_name(text: str) -> str:
    """A run's name as a folder: letters, digits, dots, dashes and underscores."""
    name = re.sub(r"[^\w.-]+", "_", text.strip(), flags=re.ASCII).strip("._")
    if not name:
        raise ValueError("a run needs a name")
    return name


def object_store(env: Mapping[str, str]) -> dict[str, str]:
    """Hadoop settings of an S3 store from the usual variables; empty if no end point or key is named.

    S3_ENDPOINT may have its scheme; path-style addresses are the default, as private stores want them.
    """
    names = {"S3_ENDPOINT": "fs.s3a.endpoint", "S3_ACCESS_KEY": "fs.s3a.access.key", "S3_SECRET_KEY": "fs.s3a.secret.key", "S3_REGION": "fs.s3a.endpoint.region"}
    found = {key: env[name] for name, key in names.items() if env.get(name)}
    if not found:
        return {}
    point = found.get("fs.s3a.endpoint", "")
    secure = env.get("S3_USE_SSL", "false" if point.startswith("http://") else "true")
    if point:
        found["fs.s3a.endpoint"] = point.split("://", 1)[-1].rstrip("/")
    return found | {"fs.s3a.path.style.access": str(truth(env.get("S3_PATH_STYLE", "true"))).lower(), "fs.s3a.connection.ssl.enabled": str(truth(secure)).lower()}


def use_object_store(spark: SparkSession, env: Mapping[str, str]) -> None:
    """Lets a session read and write s3a:// paths by these variables."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for key, value in object_store(env).items():
        conf.set(key, value)
