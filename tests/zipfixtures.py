"""Writers for report archives shaped like the published ones (test inputs only)."""

from __future__ import annotations

import os
import zipfile

PREFIX = "FacebookAdLibraryReport"
LABELS = {
    "daily": "yesterday",
    "weekly": "last_7_days",
    "30days": "last_30_days",
    "90days": "last_90_days",
    "lifelong": "lifelong",
}
HEADER_NEW = "Page ID,Page name,Disclaimer,Amount spent (USD),Number of ads in Library"
HEADER_REGION = "Page ID,Page name,Disclaimer,Amount spent (USD)"


def archive_name(label: str, date: str, suffix: str = "") -> str:
    return f"{PREFIX}_{date}_US_{label}{suffix}.zip"


def write_zip(path: str, members: dict[str, str | bytes], mtime: float | None = None) -> str:
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with zipfile.ZipFile(path, "w", compression=zipfile.ZIP_DEFLATED) as zf:
        for name, text in members.items():
            data = text if isinstance(text, bytes) else text.encode("utf-8")
            zf.writestr(name, data)
    if mtime is not None:
        os.utime(path, (mtime, mtime))
    return path


def national_member(label: str, date: str, revamp: bool = False) -> str:
    return f"{PREFIX}{'Revamp' if revamp else ''}_{date}_US_{label}_advertisers.csv"


def region_member(label: str, date: str, region: str) -> str:
    return f"regions/{PREFIX}_{date}_US_{label}_{region}.csv"


def csv_text(header: str, rows: list[str]) -> str:
    return "\n".join([header, *rows]) + "\n"
