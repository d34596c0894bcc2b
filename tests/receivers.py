"""A receiver of the tests: refuses by the record's number, and fails as a whole for some calls."""

import json


def picky(records, attempt, worst=10):
    ids = [json.loads(r)["id"] for r in records]
    if attempt == 1 and 50 in ids:
        raise OSError("connection lost")
    return [f"no {i}" if i % worst == 0 and attempt <= i // worst else None for i in ids]


def short(records, attempt):
    return []
