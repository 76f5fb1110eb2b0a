"""appraise.plans"""
