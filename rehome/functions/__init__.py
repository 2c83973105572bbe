"""Pure ``Column -> Column`` functions (built-in expressions only, no UDFs)."""

from rehome.functions.paths import *  # noqa: F401,F403
from rehome.functions.payload import *  # noqa: F401,F403
