"""Query registrations and their SQL twins."""
