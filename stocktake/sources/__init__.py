"""Text scans of received files, fingerprints, lookup seeds and layer tables."""
