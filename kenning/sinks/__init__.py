"""Writers (SNK-*)."""
from kenning.sinks.writers import *  # noqa: F401,F403
