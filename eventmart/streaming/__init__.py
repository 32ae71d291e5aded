"""Event files as they arrive: the raw layer, and figures that can't wait for the build."""
