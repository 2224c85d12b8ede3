"""Writers. Everything here runs a job."""
