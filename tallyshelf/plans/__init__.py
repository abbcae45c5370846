"""Reports over the clean tables, and the jobs that produce and publish them."""
