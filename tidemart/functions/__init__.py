"""Scalar column functions (S1-S35). All are built-in Spark expressions."""

from tidemart.functions.dates import *  # noqa: F401,F403
from tidemart.functions.strings import *  # noqa: F401,F403
from tidemart.functions.hashing import *  # noqa: F401,F403
from tidemart.functions.hexdata import *  # noqa: F401,F403
from tidemart.functions.tags import *  # noqa: F401,F403
