from keelson.streaming import scoring  # noqa: F401
