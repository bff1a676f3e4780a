"""Readers (SRC-*)."""
from kenning.sources.readers import *  # noqa: F401,F403
