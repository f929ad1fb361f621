"""Writers (K1-K7)."""

from ortholake.sinks.writers import *  # noqa: F401,F403
