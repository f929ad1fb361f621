"""Query plans over a ``Catalog``: the named query library and the catalogue analytics."""
