"""Column -> Column building blocks (native Spark SQL expressions only)."""

from kenning.functions.text import *  # noqa: F401,F403
from kenning.functions.dates import *  # noqa: F401,F403
from kenning.functions.arrays import *  # noqa: F401,F403
from kenning.functions.mathx import *  # noqa: F401,F403
