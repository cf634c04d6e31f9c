"""Column-level helpers (JVM expressions only, no Python UDFs)."""

from eventide.functions.text import (drop_static_assets, exclude, only, poly_hash,
                                     salt)
from eventide.functions.time import (epoch, from_micros, local_day, micros, ntz_literal,
                                     ts_text)

__all__ = ["epoch", "from_micros", "local_day", "micros", "ntz_literal", "ts_text",
           "drop_static_assets", "exclude", "only", "poly_hash", "salt"]
