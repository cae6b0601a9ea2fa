"""Column-expression helpers (all JVM-side built-ins, no Python UDFs)."""

from adspark.functions.parsing import *  # noqa: F401,F403
from adspark.functions.metrics import *  # noqa: F401,F403
