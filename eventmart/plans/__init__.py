"""Reports over the marts, and the build that writes them."""
