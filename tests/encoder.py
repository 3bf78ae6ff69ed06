"""Writers of the file formats."""

from pointstream.sources.writer import *  # noqa: F403
