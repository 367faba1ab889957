"""DataFrame -> DataFrame operators."""

from tarmac.operators import airports, features, keyed, models, registry, scoring  # noqa: F401
