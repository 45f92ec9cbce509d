"""The three-layer folder layout."""

LAYERS = ("raw", "silver", "gold")


class Lake:
    """Paths ``<root>/{raw,silver,gold}/<dataset>``."""

    def __init__(self, root):
        self.root = root.rstrip("/")

    def path(self, layer, dataset):
        if layer not in LAYERS:
            raise ValueError(f"unknown layer {layer!r}, expected one of {LAYERS}")
        return f"{self.root}/{layer}/{dataset}"

    def raw(self, dataset):
        return self.path("raw", dataset)

    def silver(self, dataset):
        return self.path("silver", dataset)

    def gold(self, dataset):
        return self.path("gold", dataset)
