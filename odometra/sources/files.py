"""Files of a local or remote store for Python data sources, and folders of which readers see whole versions only."""

from __future__ import annotations

import uuid

import pyarrow.fs as pafs

#: The file that names the version which readers take.
CURRENT = "CURRENT"


def located(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a URI or a local path."""
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)


def data_files(path: str) -> list[str]:
    """The file itself, or the files of a folder in order; hidden ones and markers are left out."""
    fs, at = located(path)
    info = fs.get_file_info(at)
    if info.type == pafs.FileType.File:
        return [path]
    if info.type == pafs.FileType.NotFound:
        raise FileNotFoundError(path)
    found = fs.get_file_info(pafs.FileSelector(at))
    return [f"{path.rstrip('/')}/{f.base_name}" for f in sorted(found, key=lambda f: f.base_name) if f.type == pafs.FileType.File and not f.base_name.startswith((".", "_")) and f.base_name != CURRENT]


def new_version() -> str:
    return f"v-{uuid.uuid4().hex}"


def staging(path: str, version: str) -> str:
    return f"{path.rstrip('/')}/.{version}"


def publish(path: str, version: str, wanted: list[str]) -> None:
    """Make a staged version the one that readers see.

    Files that no successful task named are deleted first. The folder gets its name, and then
    the file that names the version is replaced by one rename: before it readers see the
    version before, after it this one. Older versions stay until vacuum().
    """
    fs, at = located(path)
    staged = staging(at, version)
    keep = set(wanted)
    for f in fs.get_file_info(pafs.FileSelector(staged)):
        if f.base_name not in keep:
            fs.delete_file(f.path)
    fs.move(staged, f"{at.rstrip('/')}/{version}")
    name = f"{at.rstrip('/')}/.{CURRENT}-{version}"
    with fs.open_output_stream(name) as out:
        out.write(version.encode())
    fs.move(name, f"{at.rstrip('/')}/{CURRENT}")


def discard_staged(path: str, version: str) -> None:
    fs, at = located(path)
    staged = staging(at, version)
    if fs.get_file_info(staged).type != pafs.FileType.NotFound:
        fs.delete_dir(staged)


def current_version(path: str) -> str | None:
    """Name of the version that readers see; none before the first commit."""
    fs, at = located(path)
    name = f"{at.rstrip('/')}/{CURRENT}"
    if fs.get_file_info(name).type == pafs.FileType.NotFound:
        return None
    with fs.open_input_stream(name) as f:
        return f.read().decode()


def vacuum(path: str) -> list[str]:
    """Delete all versions but the current one, and what failed writers left; for when no reader is at work."""
    fs, at = located(path)
    keep, gone = current_version(path), []
    for f in fs.get_file_info(pafs.FileSelector(at)):
        if f.type == pafs.FileType.Directory and f.base_name.removeprefix(".").startswith("v-") and f.base_name != keep:
            fs.delete_dir(f.path)
            gone.append(f.base_name)
    return gone
