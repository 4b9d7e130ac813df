"""Where one year's refresh of one domain reads and writes."""

from __future__ import annotations

from dataclasses import dataclass

from tidemark import fixed_values as fv


@dataclass(frozen=True)
class Settings:
    root: str
    domain: str
    year: str
    environment: str = "dev"

    def __post_init__(self):
        if self.domain not in fv.DOMAINS:
            raise ValueError(f"unknown domain {self.domain!r}; expected one of {', '.join(fv.DOMAINS)}")

    def in_domain(self, domain: str) -> "Settings":
        return Settings(self.root, domain, self.year, self.environment)

    @property
    def landing(self) -> str:
        return f"{self.root}/raw/{self.domain}/{self.year}"

    @property
    def historic(self) -> str:
        return f"{self.root}/historic/{self.domain}/{self.year}"

    def table_path(self, layer: str, table: str) -> str:
        return f"{self.root}/{layer}/{self.domain}/{table}"

    def log_path(self, layer: str) -> str:
        return f"{self.root}/{layer}/{self.domain}/_control/log"

    @property
    def rejects_path(self) -> str:
        return f"{self.root}/bronze/{self.domain}/_control/rejected_lines"

    def historic_path(self, month: str | None, file_name: str) -> str:
        return f"{self.historic}/{month}/{file_name}" if month else f"{self.historic}/{file_name}"
