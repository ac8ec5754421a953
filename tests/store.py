"""A key-value store for tests: a folder with a file for each key. Keys that start with b"bad" are refused."""

from pathlib import Path

from siltbed.operators import sink


class Store:
    def __init__(self, hosts, user, password, namespace, set_name):
        (host, port), *_ = hosts
        self.folder = Path(user) / f"{host}-{port}-{password}-{namespace}-{set_name}"
        self.folder.mkdir(parents=True, exist_ok=True)

    def put(self, key, bins, ttl):
        if key.startswith(b"bad"):
            raise ValueError("refused")
        try:
            with open(self.folder / key.hex(), "xb") as f:
                f.write(b"".join(bins.values()))
        except FileExistsError:
            raise sink.Exists from None

    def close(self):
        pass
