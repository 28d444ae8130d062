"""Work lists, request manifests, and the jobs that load and refresh the warehouse."""
