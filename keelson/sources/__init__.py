from keelson.sources import readers, writers  # noqa: F401
