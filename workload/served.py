"""The two ends that a feed has outside of Spark, for the queries: a feed that is polled, and a receiver that refuses records."""

from __future__ import annotations

import json
import uuid

from pyarrow import fs


def fetch(location: str, tick: int, root: str) -> str:
    """What one location gave at one tick: lines of JSON, none if nothing happened. An unknown location is an error."""
    system, path = fs.FileSystem.from_uri(root)
    places = {f.base_name for f in system.get_file_info(fs.FileSelector(path)) if f.type == fs.FileType.Directory}
    if f"location={location}" not in places:
        raise OSError("no such place")
    files = system.get_file_info(fs.FileSelector(f"{path}/location={location}/tick={tick}", allow_not_found=True))
    names = sorted(f.path for f in files if f.base_name.startswith("part-"))
    return "\n".join(system.open_input_stream(n).read().decode().strip() for n in names)


def receive(records: list[str], attempt: int, folder: str) -> list[str | None]:
    """Takes records into a file per call. Every seventh id is throttled at first, every thirteenth of those always."""
    ids = [json.loads(r)["event_id"] for r in records]
    errors = ["throttled" if i % 91 == 0 or (i % 7 == 0 and attempt == 1) else None for i in ids]
    system, path = fs.FileSystem.from_uri(folder)
    system.create_dir(path)
    with system.open_output_stream(f"{path}/{uuid.uuid4().hex}.json") as out:
        out.write("".join(r + "\n" for r, e in zip(records, errors, strict=True) if e is None).encode())
    return errors
