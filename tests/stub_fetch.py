"""A web service for tests."""

import json


def listing(url):
    page = int(url.rsplit("=", 1)[1])
    names = {1: ["a.zip", "b.zip"], 2: ["a.zip"]}[page]
    return 200, {}, json.dumps([{"name": n, "size": page, "browser_download_url": f"u/{n}"} for n in names]).encode()


def recovery(url):
    return (404, {}, b"") if "missing" in url else (200, {}, b"page " + url.encode())


def short_last(url):
    page = int(url[1:])
    return 200, {}, str([10 * page + i for i in range(3 if page < 3 else 1)]).encode()


def upper():
    return lambda texts, parameters: [t.upper() for t in texts]
