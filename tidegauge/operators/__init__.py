"""DataFrame operators over samples and snapshot tables."""
