"""Column expressions; all run inside the JVM."""

from tidetable.functions import dates, nested, numeric, text

__all__ = ["dates", "nested", "numeric", "text"]
