from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Layout:
    """Paths of the tables under one root; batch dates are partitions, not path parts."""

    root: str

    def _under(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    @property
    def bronze(self) -> str:
        return self._under("bronze")

    @property
    def silver(self) -> str:
        return self._under("silver")

    def silver_version(self, version: str) -> str:
        """One written state of Silver; the table says which one holds."""
        return self._under("silver", f"version-{version}")

    @property
    def silver_daily(self) -> str:
        """Silver kept by the day; a batch table, as Bronze is."""
        return self._under("silver_daily")

    @property
    def silver_ledger(self) -> str:
        return self._under("silver_daily", "_ledger.json")

    @property
    def key_states(self) -> str:
        return self._under("silver_keys")

    def key_state(self, version: str) -> str:
        return self._under("silver_keys", f"version-{version}")

    def partials(self, name: str) -> str:
        """Partial sums per day, which the marts are added up from."""
        return self._under("partials", name)

    @property
    def partials_ledger(self) -> str:
        return self._under("partials", "_ledger.json")

    def gold(self, mart: str) -> str:
        return self._under("gold", mart)

    def page_index(self, mart: str) -> str:
        """The pages of a mart, written once per version of it."""
        return self._under("pages", mart)

    def export(self, mart: str) -> str:
        return self._under("exports", mart)

    def model(self, name: str) -> str:
        return self._under("models", name)
