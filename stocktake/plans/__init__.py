"""The Bronze, Silver, quarantine and Gold steps, reports and quality checks."""
