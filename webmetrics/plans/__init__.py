"""Plan-level helpers: join strategy guards, batch fact build, query catalog."""
