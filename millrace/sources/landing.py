"""Landing zone: idempotent fetches into the raw folder.

Fetching is injected, so the contract (skip what is there, leave no partial file,
report every source's outcome and go on) holds with any transport.
"""

from __future__ import annotations

import shutil
import urllib.request
import zipfile
from collections.abc import Callable, Iterable
from pathlib import Path


class ManualDownloadRequired(Exception):
    """The source is gated; its text says what to fetch by hand."""


def http_open(url: str, chunk: int = 8192, timeout: int = 60) -> Iterable[bytes]:
    with urllib.request.urlopen(url, timeout=timeout) as response:
        while part := response.read(chunk):
            yield part


def fetch(url: str, target: str | Path, opener: Callable[[str], Iterable[bytes]] = http_open) -> bool:
    """Fetches once; False if a non-empty file is there.  An error removes the partial file."""
    target = Path(target)
    if target.exists() and target.stat().st_size > 0:
        return False
    target.parent.mkdir(parents=True, exist_ok=True)
    partial = target.with_name(target.name + ".part")
    try:
        with partial.open("wb") as f:
            for part in opener(url):
                f.write(part)
        partial.replace(target)
    except BaseException:
        partial.unlink(missing_ok=True)
        raise
    return True


def extract_zip(archive: str | Path, folder: str | Path) -> list[str]:
    """Unpacks members that stay inside ``folder``; returns their names."""
    folder = Path(folder).resolve()
    with zipfile.ZipFile(archive) as z:
        names = [n for n in z.namelist() if (folder / n).resolve().is_relative_to(folder)]
        z.extractall(folder, names)
    return names


def gated(command: list[str], run: Callable[[list[str]], int] | None = None, instructions: str = "") -> None:
    """Runs a vendor's command line if it is installed, else asks for a manual download."""
    import subprocess

    if run is None:
        if shutil.which(command[0]) is None:
            raise ManualDownloadRequired(instructions or f"{command[0]} is not installed")
        run = lambda c: subprocess.run(c, check=False).returncode
    if run(command) != 0:
        raise ManualDownloadRequired(instructions or f"{' '.join(command)} failed")


def fetch_all(sources: dict[str, Callable[[], object]]) -> dict[str, str]:
    """Outcome of each source: OK, MANUAL or FAILED with the reason; one failure stops no other."""
    outcome = {}
    for name, job in sources.items():
        try:
            job()
            outcome[name] = "OK"
        except ManualDownloadRequired as e:
            outcome[name] = f"MANUAL: {e}"
        except Exception as e:  # noqa: BLE001 - the report is the point
            outcome[name] = f"FAILED: {e}"
    return outcome
