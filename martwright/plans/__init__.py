"""Views, analytics, audit, load and live-table queries."""
