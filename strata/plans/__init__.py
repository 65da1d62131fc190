"""Plans: the football configuration, gold builders, versioned store,
end-to-end pipeline and the query catalogue over the driver tables."""
