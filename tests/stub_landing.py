"""A rate-limited service for tests. Its folder holds the time, the items there are, and what it was asked."""

import json
from pathlib import Path

SIZE = 4


def clock(state):
    return float((Path(state).parent / "service" / "clock").read_text())


def fetch(url, headers):
    folder, page = Path(url.split("?")[0].removeprefix("stub:")), int(url.rsplit("=", 1)[1])
    with (folder / f"asked-{page}").open("a") as f:
        f.write("x")
    n, items = len((folder / f"asked-{page}").read_text()), json.loads((folder / "items").read_text())
    if page == 2 and n == 1:
        return 503, {}, b""
    if page == 3 and n <= 2:
        return 429, {"Retry-After": "5" if n == 1 else "9999"}, b""
    if page == 4:
        return 404, {}, b""
    if page == 5 and n < 9:
        raise ConnectionError("no answer")
    found = items[(page - 1) * SIZE : page * SIZE]
    tag = f'"{page}-{len(found)}"'
    return (304, {}, b"") if headers.get("If-None-Match") == tag else (200, {"ETag": tag}, json.dumps(found).encode())
