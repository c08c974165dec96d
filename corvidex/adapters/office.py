"""Conversion by LibreOffice."""

from __future__ import annotations

import os
import shutil
import subprocess
import tempfile


def find_tool(names: tuple[str, ...] = ("soffice", "libreoffice")) -> str:
    for n in names:
        if found := shutil.which(n):
            return found
    raise RuntimeError("LibreOffice isn't installed")


def convert(path: str, output: str, slot: int, timeout: int) -> tuple[int, bytes]:
    """Convert to PDF under a profile of the slot's own, so that several instances can run at once."""
    tool = find_tool()
    with tempfile.TemporaryDirectory() as out:
        try:
            done = subprocess.run([tool, f"-env:UserInstallation=file://{tempfile.gettempdir()}/office-profile-{slot}", "--headless", "--convert-to", "pdf", "--outdir", out, path], capture_output=True, timeout=timeout)
        except subprocess.TimeoutExpired as e:
            raise TimeoutError(str(e)) from e
        made = [n for n in os.listdir(out) if n.endswith(".pdf")]
        if done.returncode == 0 and made:
            os.makedirs(os.path.dirname(output), exist_ok=True)
            shutil.move(os.path.join(out, made[0]), output)
        return done.returncode, done.stderr
