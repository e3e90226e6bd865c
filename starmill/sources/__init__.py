"""Reading staged tables, resolving their headers, and the versioned warehouse."""
