"""DataFrame-to-DataFrame operators; each builds a lazy plan and lets Catalyst choose the strategy."""
