"""Import every module that registers queries."""

from starload.queries import changes, cleaning, files, loads, projects  # noqa: F401
