"""appraise.ml"""
