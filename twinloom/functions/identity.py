"""Twin ids that depend on nothing but a seed and a key name."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from twinloom import vocab


def twin_identity(key_name: Column, seed: str, prefix: str = vocab.DID_PREFIX) -> Column:
    """The same key name under the same seed always gives the same id."""
    digest = F.sha2(F.concat_ws(":", F.lit(seed), key_name.cast("string")), 256)
    return F.when(
        key_name.isNotNull(), F.concat(F.lit(prefix), F.substring(digest, 1, 32))
    )
