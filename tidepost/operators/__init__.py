"""DataFrame operators; a DataFrame goes in, a DataFrame comes out, nothing is collected."""
