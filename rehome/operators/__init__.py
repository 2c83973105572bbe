"""DataFrame operators: ``DataFrame (+ DataFrame) -> DataFrame``."""
