"""File sources (explicit schemas, all samples in one job)."""

from ortholake.sources.files import *  # noqa: F401,F403
