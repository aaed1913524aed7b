"""String options with typed access: blank is absent, booleans are lenient, numbers have a least value."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field


class OptionError(ValueError):
    """An option has a value that it can't have."""


@dataclass(frozen=True)
class Options:
    values: Mapping[str, str] = field(default_factory=dict)
    #: Names to show instead of an option's own in errors, for callers with friendlier ones.
    aliases: Mapping[str, str] = field(default_factory=dict)

    @classmethod
    def of(cls, values: Mapping[str, object] | Options | None = None, **more: object) -> Options:
        if isinstance(values, Options):
            return values
        return cls({k: str(v).lower() if isinstance(v, bool) else str(v) for k, v in {**(values or {}), **more}.items() if v is not None})

    def shown(self, name: str) -> str:
        return self.aliases.get(name, name)

    def text(self, name: str, default: str | None = None) -> str | None:
        value = self.values.get(name, "").strip()
        return value or default

    def has(self, *names: str) -> bool:
        return any(self.text(n) is not None for n in names)

    def flag(self, name: str, default: bool = False) -> bool:
        value = self.text(name)
        return default if value is None else value.lower() == "true"

    def number(self, name: str, default: int, least: int | None = None) -> int:
        value = self.text(name)
        if value is None:
            return default
        try:
            number = int(value)
        except ValueError:
            raise OptionError(f"The value of '{self.shown(name)}' must be numeric.") from None
        if least is not None and number != default and number < least:
            raise OptionError(f"The value of '{self.shown(name)}' must be {least} or greater.")
        return number

    def listed(self, name: str, delimiter: str = ",") -> list[str]:
        return [x.strip() for x in (self.text(name) or "").split(delimiter) if x.strip()]

    def lines(self, name: str) -> list[str]:
        return self.listed(name, "\n")

    def family(self, prefix: str) -> dict[str, str]:
        """The options under a prefix, by the rest of their names."""
        return {k[len(prefix) :]: v for k, v in self.values.items() if k.startswith(prefix) and len(k) > len(prefix)}

    def exclusive(self, *names: str) -> None:
        given = [self.shown(n) for n in names if self.has(n)]
        if len(given) > 1:
            raise OptionError(f"Only one of {' and '.join(given)} may be set.")
