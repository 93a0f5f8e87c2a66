"""Part of assayloom; see the README for the layout."""
